"""Odd input that every operator must take, and small helpers."""

from __future__ import annotations

LONG = ("alpha beta gamma delta epsilon zeta eta theta iota kappa " * 4000).strip()
PROSE = " ".join(f"word{i % 37}x{i}" for i in range(80))

DOCS = [
    (1, PROSE, "en", "a.org", 5, "x", 1),
    (1, PROSE, "en", "a.org", 5, "x", 1),          # the same row again
    (2, PROSE, "en", "b.org", None, None, 2),      # a copy under another id
    (3, None, "en", "a.org", None, "y", None),
    (4, "", None, None, 0, "y", 3),
    (5, " \t\n\r\x0b\x0c", "fr", "a.org", 6, None, 3),
    (6, "one", "fr", None, 3, None, 3),
    (7, LONG, "en", "a.org", len(LONG), None, 3),
    (8, "𝒳𝒴 é ü   — 日本語 & <b> 42", "de", "c.org", None, None, 3),
    (None, PROSE + " and more", None, "c.org", None, None, 3),
    (None, None, None, None, None, None, None),
    (9, "\n".join(["same line here"] * 30), "es", "c.org", None, None, 3),
]
# Further columns whose names clash with those the operators use themselves.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "size string, kept int")


def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return [tuple(r) for r in df.collect()]


def ordered(values):
    return sorted(values, key=lambda t: tuple((x is not None, x) for x in t))
