"""op9: language identification by cross-parsing entropy over suffix automata.

A bounded sample of labelled text per language becomes one suffix automaton each. A text
is parsed against every automaton into the fewest phrases that occur in its sample, by
always taking the longest match; phrases per symbol grow with the cross entropy, and the
language with the fewest wins. Ties, common among very short texts, go to the language
with more labelled documents, then to the smaller code.

Texts are read as lower-cased letters, any run of other characters being one separator.
A phrase begins with every symbol that does not go on from the state before, so phrases are
counted by their beginnings. Texts are parsed in pieces of ``PIECE`` symbols side by side,
first as if a phrase began with each piece; then each piece is read again from the state in
which the one before ends, as far as its states differ (rarely for long, as both ways soon
break at the same place). The result is the parse of the whole text, phrases across piece
ends included, and memory depends on neither text length nor batch size. A text whose
pieces do not settle in ``TOGETHER`` rounds goes on piece by piece.

Automata are kept as combs (rows of transitions laid into each other's gaps), whose size
follows the sample and not the number of letters, so no learned letter is left out.

Defined results for odd input: null texts, texts without a letter, and every text when
nothing labelled was learned are ``und`` with score 0; rows with a null id or null
language teach nothing; a language needs no minimum of text; repeated rows are predicted
alike; letters that no sample holds are phrases of their own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.llm.common import bounded_batches, table
from tarmac.llm.tokens import row_slices

# The bounded training sample: so many documents per language (smallest hash of the id),
# so many code points in a row of each, from a place that the id's hash chooses.
SAMPLE_DOCS, SAMPLE_CHARS = 64, 400
PIECE = 256       # symbols parsed in a row
LANES = 1 << 20   # symbols in flight at once
TOGETHER = 3      # rounds in which all unsettled pieces are read again
WINDOW = 512      # slots of a comb looked at together

SEPARATOR = 0     # letters follow, then one symbol for letters never learned


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the root."""
    step: list[dict[int, int]] = [{}]
    link, longest, last = [-1], [0], 0
    for c in symbols:
        cur = len(step)
        step.append({})
        link.append(0)
        longest.append(longest[last] + 1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if longest[q] == longest[p] + 1:
                link[cur] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                longest.append(longest[p] + 1)
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return step


@dataclass
class Automaton:
    """A comb: the move of ``state`` on ``symbol``, if any, is at base[state] + symbol."""

    base: np.ndarray
    slots: np.ndarray    # the state whose move is in a slot (-1: free) << 32 | where it goes
    first: np.ndarray    # symbol -> state after a phrase's first symbol (0: unknown symbol)


@dataclass
class Model:
    languages: list[str]
    symbol: np.ndarray   # code point -> symbol
    automata: list[Automaton]


def comb(step: list[dict[int, int]], width: int) -> Automaton:
    """Lays the rows of all states but the root into one array, those of most moves first.
    ``width`` empty slots at both ends catch looks beyond a row."""
    grow = sum(map(len, step)) + 2 * width + WINDOW
    free = np.ones(grow, bool)
    base = np.zeros(len(step), np.int64)
    low = 0  # rows of several moves are placed from here on
    for s in sorted((s for s in range(1, len(step)) if len(step[s]) > 1), key=lambda s: -len(step[s])):
        symbols = np.array(sorted(step[s]), np.int64) - min(step[s])
        at = low
        while True:
            if at + WINDOW + width > len(free):
                free = np.append(free, np.ones(grow, bool))
            start = at + np.flatnonzero(free[at:at + WINDOW])
            fits = np.flatnonzero(free[start[:, None] + symbols].all(1)) if len(start) else start
            if len(fits):
                break
            # A window that is nearly full is left to rows of one move, which fit anywhere.
            low = at + WINDOW if at == low and len(start) < WINDOW // 8 else low
            at += WINDOW
        base[s] = start[fits[0]] - min(step[s])
        free[start[fits[0]] + symbols] = False
    single = [s for s in range(1, len(step)) if len(step[s]) == 1]
    place = np.flatnonzero(np.append(free, np.ones(len(single), bool)))[:len(single)]
    base[single] = place - np.array([next(iter(step[s])) for s in single], np.int64)
    base += width
    moves = np.array([(s, c, t) for s in range(1, len(step)) for c, t in step[s].items()], np.int64).reshape(-1, 3)
    at = base[moves[:, 0]] + moves[:, 1]
    base[[s for s in range(len(step)) if not s or not step[s]]] = at.max(initial=0) + 1
    slots = np.full(base[0] + width, -1 << 32, np.int64)
    slots[at] = moves[:, 0] << 32 | moves[:, 2]
    first = np.zeros(width, np.int64)
    first[list(step[0])] = list(step[0].values())
    return Automaton(base, slots, first)


def _symbols(letters: list[str]) -> np.ndarray:
    points = [chr(p) if not 0xD800 <= p < 0xE000 else " " for p in range(0x110000)]
    out = np.where(np.fromiter(map(str.isalpha, points), bool, len(points)), len(letters) + 1, SEPARATOR)
    for k, letter in enumerate(letters):
        for form in {letter, letter.upper()}:
            if len(form) == 1:
                out[ord(form)] = k + 1
    return out.astype(np.min_scalar_type(len(letters) + 1))


def fold(symbol: np.ndarray, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all texts, first symbol of each text + total): one separator per run
    of other characters, none in front."""
    ends = np.cumsum([0, *map(len, texts)])
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    s = symbol[points]
    before = np.empty_like(s)
    before[1:] = s[:-1]
    before[ends[:-1][ends[:-1] < len(s)]] = SEPARATOR
    keep = (s != SEPARATOR) | (before != SEPARATOR)
    return s[keep], np.concatenate([[0], np.cumsum(keep)])[ends]


def learn(samples: dict[str, list[str]]) -> Model:
    """Automata from texts by language; the order of languages decides ties."""
    letters = sorted({c for texts in samples.values() for t in texts for c in t.lower() if c.isalpha()})
    model = Model([], _symbols(letters), [])
    for language in samples:
        text, _ = fold(model.symbol, samples[language])
        if (text != SEPARATOR).any():
            model.languages.append(language)
            model.automata.append(comb(suffix_automaton(text.tolist()), len(letters) + 2))
    return model


def _move(a: Automaton, state: np.ndarray, symbol: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(next states, whether a phrase begins with the symbol)."""
    move = a.slots.take(a.base.take(state) + symbol)
    begins = (move >> 32) != state
    # The root owns no slot, so a phrase begins with every symbol read there.
    return np.where(begins, first, move & 0xFFFFFFFF), begins


def _beginnings(a: Automaton, lanes: np.ndarray, owner: np.ndarray, before: int) -> tuple[np.ndarray, int]:
    """Where phrases begin in the pieces ``lanes[:, j]`` of the texts ``owner[j]``, and the
    state after the last one. ``before``: the state in front of the first piece."""
    follows = np.concatenate([[False], owner[1:] == owner[:-1]])
    entry = np.zeros(lanes.shape[1], np.int64)
    entry[0] = before
    states, begins = np.empty(lanes.shape, np.int32), np.empty(lanes.shape, bool)
    state, first = entry, a.first.take(lanes)
    for k in range(len(lanes)):
        state, begins[k] = _move(a, state, lanes[k], first[k])
        states[k] = state
    turn = 0
    while True:
        true = np.where(follows, np.concatenate([[0], states[-1, :-1]]), entry)
        lane = np.flatnonzero(true != entry)
        if not len(lane):
            return begins, int(states[-1, -1])
        if turn >= TOGETHER:  # the first unsettled piece of each text
            lane = lane[np.unique(owner[lane], return_index=True)[1]]
        turn += 1
        entry[lane] = state = true[lane]
        for k in range(len(lanes)):
            state, begins[k, lane] = _move(a, state, lanes[k, lane], first[k, lane])
            other = state != states[k, lane]
            states[k, lane] = state
            lane, state = lane[other], state[other]
            if not len(lane):
                break


def phrases(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(phrases per language and text, symbols per text that has a letter, else 0)."""
    s, off = fold(model.symbol, texts)
    size = np.diff(off)
    letters = np.concatenate([[0], np.cumsum(s != SEPARATOR)])
    size = np.where(np.diff(letters[off]) > 0, size, 0)
    pieces = -(-size // PIECE)
    owner = np.repeat(np.arange(len(texts)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = off[owner] + nth * PIECE
    stop = np.minimum(start + PIECE, off[owner] + size[owner])
    out = np.zeros((len(model.languages), len(texts)), np.int64)
    last = [0] * len(out)
    for lo in range(0, len(owner), LANES // PIECE):
        part = slice(lo, lo + LANES // PIECE)
        at = start[part] + np.arange(min(PIECE, int((stop[part] - start[part]).max())))[:, None]
        real = at < stop[part]
        lanes = s[np.where(real, at, 0)]
        for k, a in enumerate(model.automata):
            begins, last[k] = _beginnings(a, lanes, owner[part], last[k] if nth[lo] else 0)
            out[k] += np.bincount(owner[part], (begins & real).sum(0), len(texts)).astype(np.int64)
    return out, size


def predict(model: Model, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text; the score is 1 - fewest / second-fewest phrases."""
    if not model.languages:
        return ["und"] * len(texts), np.zeros(len(texts))
    counts, size = phrases(model, texts)
    best = counts.argmin(axis=0)
    ranked = np.sort(counts, axis=0)
    second = ranked[1] if len(ranked) > 1 else np.full(len(texts), np.inf)
    score = np.where(size > 0, np.clip(1 - ranked[0] / np.maximum(second, 1), 0, 1), 0)
    return [model.languages[b] if n else "und" for b, n in zip(best, size)], score


def held_out(id_col: str) -> Column:
    """Documents that are never learned from: crc32 of the id's text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learns from a bounded sample of the labelled, not held-out documents."""
    d = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
                    F.col(text_col).alias("text"))
    d = d.filter(F.col("lang").isNotNull() & F.col("id").isNotNull() & F.col("text").isNotNull()
                 & ~held_out("id"))
    h = F.xxhash64(F.col("id").cast("string"))
    start = F.pmod(F.xxhash64(h), F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1) + 1
    head = d.select("lang", h.alias("h"), F.substring("text", start.cast("int"), F.lit(SAMPLE_CHARS)).alias("text"))
    # Only a language's first rows by hash leave a task (the planner limits each group).
    order = Window.partitionBy("lang").orderBy("h", "text")
    rows = head.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= SAMPLE_DOCS).collect()
    labelled = sorted(d.groupBy("lang").count().collect(), key=lambda r: (-r["count"], r.lang))
    samples: dict[str, list[str]] = {r.lang: [] for r in labelled}
    for r in sorted(rows, key=lambda r: r["rank"]):
        samples[r.lang].append(r.text + "\n")
    return learn(samples)


def with_language(docs: DataFrame, model: Model, out: str, text_col: str = "text") -> DataFrame:
    """``docs`` plus a struct column (lang_pred, score) predicted from the text alone."""
    shared = bounded_batches(docs).sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def language(text: pa.Array) -> pa.Array:
        langs, scores = [], []
        for lo, hi in row_slices(text):
            got, score = predict(shared.value, [t or "" for t in text[lo:hi].to_pylist()])
            langs += got
            scores.append(score)
        score = np.concatenate(scores) if scores else np.zeros(0)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(score, pa.float64())],
                                          ["lang_pred", "score"])

    return docs.withColumn(out, language(F.col(text_col).cast("string")))


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               lang_col: str = "lang") -> DataFrame:
    """Per document row: (doc_id, held_out, lang_pred, score)."""
    model = train(docs, id_col, text_col, lang_col)
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return with_language(narrow, model, "p").select("doc_id", held_out("doc_id").alias("held_out"), "p.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identified(table(spark, sf_dir, "documents"))
