"""op10: personal data by base patterns and a character BiLSTM with CRF transitions.

The base patterns find e-mail addresses, IPv4 addresses, payment cards and phone numbers
in their plain forms. The tagger is trained here, in numpy, on windows of the corpus whose
spans the base patterns label, and on rewritten windows where a labelled span is replaced
by another way of writing the same value (``rewritten``): it learns forms that no pattern
lists. Every text is covered by overlapping windows; each is decoded with the CRF, each
character takes its tag from the window in which it lies most central, tags become spans
over the whole text, and a span is added when its value is a sound one of its kind
(``sound``) and it overlaps no base span. Base spans always stay.

Every sound value holds a digit, an ``@`` or a bracketed ``at`` (``TRIGGER``), so windows
are decoded around those only. The base kinds hold a digit or ``@`` (``PLAIN``); training
windows are drawn around those, where base patterns can label.

Defined results for odd input: null and empty texts have no spans; offsets are code
points; repeated rows are tagged alike; a corpus without any trigger trains no tagger and
adds no spans; text length is unbounded (windows are decoded ``LANES`` at a time).
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.bilstm import Tagger, decode, fit
from tarmac.llm.common import bounded_batches, table

KINDS = ("email", "ip", "card", "phone")  # in the order that breaks ties of start
WINDOW, STRIDE = 96, 48
HIDDEN, ROUNDS, BATCH = 24, 220, 48
# The tagger is fitted on a bounded sample: so many distinct corpus windows (smallest hash).
TRAIN_WINDOWS = 1200
SPELLED = 3  # training rows without digits per window with an e-mail
LANES = 2048  # windows decoded at once
PLAIN = re.compile("[0-9@]")
TRIGGER = re.compile(r"[0-9@]|[\[({]\s*at\s*[\])}]", re.I)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can begin only where a run of digits does, so long runs are read once.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _digits(s: str) -> str:
    return "".join(c for c in s if c in "0123456789")


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _emails(text: str) -> list[Span]:
    """Leftmost matches of local@domain; each ``@`` is met once, so a long run without one
    costs nothing."""
    out, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns by start, then kind."""
    if not PLAIN.search(text):
        return []
    out = _emails(text)
    for m in _IP.finditer(text):
        if all(_small(p) for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        d = _digits(m.group())
        if 12 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_AT = re.compile(r"\s*[\[({]\s*at\s*[\])}]\s*|\s+@\s*|\s*@\s+", re.I)
_DOT = re.compile(r"\s*[\[({]\s*(?:dot|\.)\s*[\])}]\s*", re.I)


def sound(kind: str, value: str) -> bool:
    """Whether a tagged value is one of its kind once its writing is undone."""
    if kind in ("email", "ip"):
        plain = _DOT.sub(".", _AT.sub("@", value))
        return (kind, 0, len(plain)) in base_spans(plain)
    d = _digits(value)
    rest = set(value) - set("0123456789")
    if not value[:1] or value[-1] not in "0123456789":
        return False
    if kind == "card":
        return 12 <= len(d) <= 19 and luhn(d) and rest <= set(" -./_") and not re.search(r"[^0-9]{3}", value)
    return (9 <= len(d) <= 15 and rest <= set(" ()-./+") and value[0] in "(+0123456789"
            and (value.startswith("00") or "(" in value or re.search(r"[0-9][ ./-][0-9]", value) is not None)
            and not re.search(r"[^0-9]{4}", value) and not luhn_like(d, value))


def luhn_like(digits: str, value: str) -> bool:
    """Four dotted small numbers or a card are not taken for a phone."""
    parts = value.split(".")
    return len(parts) == 4 and all(p.isdigit() and _small(p) for p in parts) or (
        len(digits) >= 13 and luhn(digits))


def rewritten(kind: str, value: str, rng: np.random.Generator) -> str:
    """Another way of writing a base value."""
    pick = lambda *a: a[rng.integers(len(a))]
    if kind == "email":
        return value.replace("@", pick(" [at] ", "[at]", " (at) ", "(at)", " @ ", "@")).replace(
            ".", pick("[.]", " [dot] ", "(dot)", "."))
    if kind == "ip":
        return value.replace(".", pick("[.]", "(.)", "[dot]", " [.] "))
    d = _digits(value)
    if kind == "card":
        sep, size = pick(".", "/", "_", " - ", "  "), pick(4, 4, 4, 6)
        return sep.join(d[k:k + size] for k in range(0, len(d), size))
    d, sep = d[-10:].rjust(9, "2"), pick("-", " ", ".", "/")
    area, rest = d[:len(d) - 7], d[-7:]
    return pick(f"({area}) {rest[:3]}{sep}{rest[3:]}", f"{area}{sep}{rest[:3]}{sep}{rest[3:]}",
                f"001 {area} {rest[:3]}{sep}{rest[3:]}", f"0{area}{sep}{rest}")


# Tags: 0 outside, then begin and inside per kind.
TAGS = 1 + 2 * len(KINDS)
ALLOWED = np.ones((TAGS, TAGS), bool)
for _k in range(len(KINDS)):
    ALLOWED[:, 2 + 2 * _k] = False
    ALLOWED[[1 + 2 * _k, 2 + 2 * _k], 2 + 2 * _k] = True
START = np.array([t == 0 or t % 2 == 1 for t in range(TAGS)])

# Symbols: pad, other, space, letter of another script, digit, ASCII letters, punctuation.
PUNCTUATION = "@.+-()_%[]{}/:=\"',&*#$!|~"
VOCAB = 5 + 26 + len(PUNCTUATION)


def _symbol_table() -> np.ndarray:
    out = np.ones(0x10000, np.uint8)
    out[[ord(c) for c in " \t\n\r\v\f"]] = 2
    out[0xAA:] = 3
    out[48:58] = 4
    out[97:123] = out[65:91] = np.arange(5, 31)
    for k, c in enumerate(PUNCTUATION):
        out[ord(c)] = 31 + k
    return out


SYMBOL = _symbol_table()


def encode(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return SYMBOL[np.minimum(points, 0xFFFF)]


def window_starts(text: str, trigger: re.Pattern = TRIGGER) -> list[int]:
    """Starts of the windows to decode: the grid windows in which a trigger begins."""
    found = {max(0, m.start() // STRIDE - d) for m in trigger.finditer(text) for d in (0, 1)}
    return [k * STRIDE for k in sorted(found)]


def tag_spans(tags: np.ndarray) -> list[Span]:
    """Spans of a whole text's tags; an inside tag that follows nothing of its kind begins one."""
    change = np.flatnonzero(np.diff(tags, prepend=0) != 0)
    out: list[Span] = []
    for k, a in enumerate(change):
        t = int(tags[a])
        if not t:
            continue
        b = int(change[k + 1]) if k + 1 < len(change) else len(tags)
        kind = KINDS[(t - 1) // 2]
        if t % 2 == 0 and out and out[-1][0] == kind and out[-1][2] == a:
            out[-1] = (kind, out[-1][1], b)
        else:
            out.append((kind, int(a), b))
    return out


def tagged(tagger: Tagger, texts: list[str]) -> list[list[Span]]:
    """Spans that the tagger adds to each text, before base spans are considered."""
    starts = [window_starts(t) for t in texts]
    owner = [(i, s) for i, ss in enumerate(starts) for s in ss]
    spans: list[list[Span]] = [[] for _ in texts]
    if not owner:
        return spans
    x = np.zeros((len(owner), WINDOW), np.uint8)
    for k, (i, s) in enumerate(owner):
        piece = encode(texts[i][s:s + WINDOW])
        x[k, :len(piece)] = piece
    y = np.concatenate([decode(tagger, x[k:k + LANES]) for k in range(0, len(x), LANES)])
    at = 0
    margin = (WINDOW - STRIDE) // 2
    for i, ss in enumerate(starts):
        # Neighbouring decoded windows form a region; gaps between regions are outside.
        k = 0
        while k < len(ss):
            j = k
            while j + 1 < len(ss) and ss[j + 1] == ss[j] + STRIDE:
                j += 1
            lo, hi = ss[k], min(ss[j] + WINDOW, len(texts[i]))
            tags = np.zeros(max(hi - lo, 0), np.int8)
            for w in range(k, j + 1):
                a = ss[w] + (margin if w > k else 0)
                b = ss[w] + (WINDOW - margin if w < j else WINDOW)
                b = min(b, hi)
                if b > a:
                    tags[a - lo:b - lo] = y[at + w][a - ss[w]:b - ss[w]]
            spans[i] += [(kind, lo + a, lo + b) for kind, a, b in tag_spans(tags)]
            k = j + 1
        at += len(ss)
    return spans


def _clear(starts: list[int], reach: list[int], a: int, b: int) -> bool:
    """Whether no base span overlaps a:b."""
    k = bisect_left(starts, b)
    return not k or reach[k - 1] <= a


def all_spans(tagger: Tagger | None, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text; both by start, then kind."""
    added = tagged(tagger, texts) if tagger else [[] for _ in texts]
    out = []
    for text, more in zip(texts, added):
        base = base_spans(text)
        spans = list(base)
        starts = [s[1] for s in base]
        reach = list(accumulate((s[2] for s in base), max))  # how far base spans go up to each
        for kind, a, b in more:
            while a < b and text[a].isspace():
                a += 1
            while b > a and (text[b - 1].isspace() or text[b - 1] in ".,;:"):
                b -= 1
            # Part of a longer word or number is not a value of its own.
            cut = text[a - 1:a].isalnum() or text[b:b + 1].isalnum()
            if a < b and not cut and sound(kind, text[a:b]) and _clear(starts, reach, a, b):
                spans.append((kind, a, b))
        out.append((base, sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))))
    return out


@F.arrow_udf(T.ArrayType(T.StringType()))
def _windows(text: pa.Array) -> pa.Array:
    """Windows around triggers for training; those that cut through a possible span are left out."""
    out = []
    for t in text.to_pylist():
        pieces = [t[s:s + WINDOW] for s in window_starts(t or "", PLAIN)]
        out.append([p for p in pieces if len(p) > 8 and not re.search(r"[0-9@+().-]", p[:2] + p[-3:])])
    return pa.array(out, pa.list_(pa.string()))


def spelled(text: str, rng: np.random.Generator) -> str:
    """An e-mail without digits, made of words of the text."""
    words = re.findall("[a-z]{2,12}", text.lower()) or ["mail"]
    pick = lambda n: [words[k] for k in rng.integers(0, len(words), n)]
    local = rng.choice([".", "-", "_"]).join(pick(rng.integers(1, 3)))
    return f"{local}@{'.'.join(pick(rng.integers(1, 3)))}.{pick(1)[0][:rng.integers(2, 4)]}"


def training_rows(windows: list[str], seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, tags) of the windows, of two rewritten forms of each labelled one, and of
    each with other e-mails without digits, plain or rewritten, in an e-mail's place."""
    rng, rng_spelled = np.random.default_rng(seed), np.random.default_rng(seed + 1)
    xs, ys = [], []

    def add(text: str, spans: list[Span]) -> None:
        x, y = np.zeros(WINDOW, np.uint8), np.zeros(WINDOW, np.int8)
        piece = encode(text)[:WINDOW]
        x[:len(piece)] = piece
        for kind, a, b in spans:
            if b <= WINDOW and not y[a:b].any():
                y[a:b] = 2 + 2 * KINDS.index(kind)
                y[a] -= 1
        xs.append(x)
        ys.append(y)

    for text in windows:
        base = base_spans(text)
        add(text, base)
        emails = [s for s in base if s[0] == "email"]
        for n in range((2 + SPELLED if emails else 2) if base else 0):
            if n < 2:
                kind, a, b = base[rng.integers(len(base))]
                new = rewritten(kind, text[a:b], rng)
            else:
                kind, a, b = emails[rng_spelled.integers(len(emails))]
                new = rewritten(kind, spelled(text, rng_spelled), rng_spelled)
            clash = any(s < b and a < e and (s, e) != (a, b) for _, s, e in base)
            if not clash and sound(kind, new):
                shift = len(new) - (b - a)
                moved = [(k, s + shift * (s > a), e + shift * (s > a)) for k, s, e in base if (s, e) != (a, b)]
                add(text[:a] + new + text[b:], [*moved, (kind, a, a + len(new))])
    return np.array(xs), np.array(ys)


def train(docs: DataFrame, text_col: str = "text") -> Tagger | None:
    """Fits the tagger on the bounded sample of windows; None if there is none."""
    texts = bounded_batches(docs).select(F.col(text_col).cast("string").alias("text")).filter(F.col("text").rlike("[0-9@]"))
    rows = (texts.select(F.explode(_windows("text")).alias("w")).distinct()
            .orderBy(F.xxhash64("w"), "w").limit(TRAIN_WINDOWS).collect())
    x, y = training_rows([r.w for r in rows])
    if not len(x) or not y.any():
        return None
    return fit(x, y, VOCAB, ALLOWED, START, HIDDEN, ROUNDS, BATCH)


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span (overlapping ones as one) replaced by its kind's name."""
    out, end = [], 0
    merged: list[list] = []
    for kind, a, b in spans:
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b])
    for kind, a, b in merged:
        out += [text[end:a], f"[{kind.upper()}]"]
        end = b
    return "".join([*out, text[end:]])


FOUND = "struct<n_email:long,n_ip:long,n_card:long,n_phone:long,base_sha256:string,spans:string,n_added:long>"
_FOUND = pa.struct([*[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()),
                    ("spans", pa.string()), ("n_added", pa.int64())])


def with_spans(docs: DataFrame, tagger: Tagger | None, out: str, text_col: str = "text") -> DataFrame:
    """``docs`` plus a struct column: base counts per kind, the digest of the base spans,
    all spans (kind:start:end, joined by commas) and how many the tagger added."""
    shared = bounded_batches(docs).sparkSession.sparkContext.broadcast(tagger)

    @F.arrow_udf(FOUND)
    def find(text: pa.Array) -> pa.Array:
        texts = [t if t and TRIGGER.search(t) else "" for t in text.to_pylist()]
        rows = []
        for base, spans in all_spans(shared.value, texts):
            kinds = [s[0] for s in base]
            rows.append({**{f"n_{k}": kinds.count(k) for k in KINDS},
                         "base_sha256": hashlib.sha256(_joined(base).encode()).hexdigest(),
                         "spans": _joined(spans), "n_added": len(spans) - len(base)})
        return pa.array(rows, _FOUND)

    return docs.withColumn(out, find(F.col(text_col).cast("string")))


def redacted(docs: DataFrame, tagger: Tagger | None, text_col: str = "text") -> DataFrame:
    """``docs`` with the spans of ``text_col`` replaced by their kinds; other columns stay."""
    shared = bounded_batches(docs).sparkSession.sparkContext.broadcast(tagger)

    @F.arrow_udf("string")
    def clean(text: pa.Array) -> pa.Array:
        texts = text.to_pylist()
        hot = [i for i, t in enumerate(texts) if t and TRIGGER.search(t)]
        for i, (_, spans) in zip(hot, all_spans(shared.value, [texts[i] for i in hot])):
            texts[i] = redact(texts[i], spans)
        return pa.array(texts, pa.string())

    return docs.withColumn(text_col, clean(F.col(text_col).cast("string")))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row: (doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added)."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return with_spans(narrow, train(narrow), "f").select("doc_id", "f.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
