"""Pieces of DuckDB SQL that several statements share."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 (reflected polynomial 0xEDB88320) of an ASCII text, bit by bit."""
    bit = "lambda x, i: xor(x >> 1, 3988292384 * (x & 1))"
    byte = f"lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], {bit})"
    codes = f"list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), {byte}), 4294967295)"
