"""op1: quality rules with host-level verdicts.

Each document is measured and held against the base rules and the ``RULES`` below. Rule
failures are aggregated by host (``source``); a host's raw failure rate is shrunk with a
beta prior fitted to the rates of all hosts (method of moments), so a host of a few
documents is not judged by them alone. A host whose shrunk rate of any rule passes
``HOST_LIMIT`` is rejected with all its documents; the verdicts are joined back. In the
other hosts a document is kept unless it fails a rule itself.

Words are runs of anything but ASCII white space. Defined results for odd input: a null
or blank text has no words (and fails); a null host is a host of its own; repeated rows
count and are judged each; an empty table gives no rows; with one host, or hosts that all
have the same rate, the prior is that rate with the weight ``PRIOR_MAX``.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.common import bounded_batches, staged, table

SYMBOLS = re.compile(rb"[#*$%&|<>]")
HOST_LIMIT = 0.5
PRIOR_MIN, PRIOR_MAX = 2.0, 1000.0  # bounds of the prior's weight, in documents
SALTS = 16  # parts of a hot host when verdicts are joined back

BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"
# Further rules, as conditions on the measures (whole numbers, so any engine agrees).
RULES = {
    "base": BASE_FAILED,
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "n_words > 0 and (word_chars < 3 * n_words or word_chars > 10 * n_words)",
}


def measure(text: str | None) -> tuple[int, int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines); lines with
    a word only."""
    if not text:
        return (0,) * 6
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # of bytes: splits at ASCII white space only
    n = len(words)
    if not n:
        return (0,) * 6
    blanks = sum(map(raw.count, (b" ", b"\n", b"\t", b"\r", b"\v", b"\f")))
    lines = [line for line in raw.split(b"\n") if line.split(None, 1)]
    repeated = 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) < len(windows):
        seen, twice = set(), set()
        for w in windows:
            (twice if w in seen else seen).add(w)
        end = 0  # words before this one are counted
        for k, w in enumerate(windows):
            if w in twice:
                repeated += k + 3 - max(end, k)
                end = k + 3
    return (n, len(text) - blanks, len(SYMBOLS.findall(raw)), len(lines) - len(set(lines)), repeated, len(lines))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


@F.arrow_udf(T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))
def _measures(text: pa.Array) -> pa.Array:
    rows = [measure(t.as_py()) for t in text]
    columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(MEASURES))]
    return pa.StructArray.from_arrays(columns, list(MEASURES))


def host_verdicts(failures: DataFrame, rules: list[str]) -> DataFrame:
    """Per host: shrunk failure rate of every rule (``rate_<rule>``) and ``host_kept``.

    ``failures`` has a column ``host`` and a 0/1 column per rule. The beta prior of a rule
    has the mean rate of all documents; its weight comes from how much the hosts' rates
    vary beyond what their sizes explain.
    """
    hosts = staged(failures.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(r).alias(r) for r in rules]), "hosts")
    sums = hosts.agg(F.sum("n").alias("total"), F.sum(F.col("n") * F.col("n")).alias("squares"),
                     F.count(F.lit(1)).alias("hosts"), *[F.sum(r).alias(r) for r in rules],
                     *[F.sum(F.col(r) * F.col(r) / F.col("n")).alias(f"square_{r}") for r in rules]).first()
    rates = []
    for r in rules:
        mean = sums[r] / sums["total"] if sums["total"] else 0.0
        weight = prior_weight(mean, sums[f"square_{r}"] or 0.0, sums["total"] or 0, sums["squares"] or 0, sums["hosts"])
        rates.append((F.col(r) + F.lit(weight * mean)) / (F.col("n") + F.lit(weight)))
    worst = F.greatest(*rates) if len(rates) > 1 else rates[0]
    return hosts.select("host", *[x.alias(f"rate_{r}") for r, x in zip(rules, rates)],
                        (worst <= HOST_LIMIT).alias("host_kept"))


def prior_weight(mean: float, square: float, total: int, squares: int, hosts: int) -> float:
    """Weight (a + b) of the beta prior by the method of moments. ``square`` is the sum
    over hosts of failures ** 2 / n; its excess over the binomial spread gives the variance
    of the hosts' true rates."""
    if not total or total * total <= squares:
        return PRIOR_MAX
    spread = square - total * mean * mean
    noise = (hosts - 1) * mean * (1 - mean)
    variance = (spread - noise) / (total - squares / total)
    if variance <= 0:
        return PRIOR_MAX
    return max(PRIOR_MIN, min(PRIOR_MAX, mean * (1 - mean) / variance - 1))


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Per document row: the measures, ``base_failed``, ``kept``, ``host_kept``."""
    rules = list(RULES)
    measured = (bounded_batches(docs).select(F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"),
                            _measures(F.col(text_col).cast("string")).alias("m"))
                .select("doc_id", "host", "m.*")
                .select("*", *[F.expr(f"cast({cond} as int)").alias(r) for r, cond in RULES.items()]))
    measured = staged(measured, "measures")
    # A host may hold any share of the documents: its rows are dealt over SALTS parts and
    # its verdict, one narrow row, is repeated for each part.
    verdicts = host_verdicts(measured, rules).select(
        F.col("host").alias("_host"), "host_kept", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    salted = measured.withColumn("_part", F.pmod(F.xxhash64("doc_id", "word_chars"), F.lit(SALTS)).cast("int"))
    joined = salted.join(verdicts, F.col("host").eqNullSafe(F.col("_host")) & (F.col("_part") == F.col("_salt")))
    failed = F.greatest(*rules) == 1
    return joined.select("doc_id", *MEASURES[:5], (F.col("base") == 1).alias("base_failed"),
                         (~failed & F.col("host_kept")).alias("kept"), "host_kept")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"))


ORACLE = r"""
with words as (
  select doc_id, source, coalesce(text, '') t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w
  from documents),
tokens as (
  select doc_id, unnest(w) x, generate_subscripts(w, 1) k from words),
windows as (
  select doc_id, k, x, lead(x) over (partition by doc_id order by k) y,
         lead(x, 2) over (partition by doc_id order by k) z from tokens),
grams as (
  select doc_id, k, count(*) over (partition by doc_id, x, y, z) c from windows where z is not null),
repeats as (
  select doc_id, count(distinct p) n from (select doc_id, unnest([k, k + 1, k + 2]) p from grams where c > 1)
  group by doc_id),
lines as (
  select doc_id, count(*) n_lines, count(*) - count(distinct l) n_dup
  from (select doc_id, unnest(string_split(t, chr(10))) l from words)
  where regexp_matches(l, '[^\x20\x09-\x0D]') group by doc_id),
measured as (
  select doc_id, source, len(w) n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) n_symbols,
         coalesce(n_dup, 0) n_dup_lines, coalesce(repeats.n, 0) n_repeat_words, coalesce(n_lines, 0) n_lines
  from words left join repeats using (doc_id) left join lines using (doc_id)),
failed as (
  select *, (n_words < 50 or 100 * n_repeat_words > 50 * n_words)::int base,
         (10 * n_symbols > n_words)::int symbols, (10 * n_dup_lines > 3 * n_lines)::int dup_lines,
         (n_words > 0 and (word_chars < 3 * n_words or word_chars > 10 * n_words))::int word_length
  from measured),
rates as (
  select source, rule, count(*)::double n, sum(f)::double f
  from (select source, unnest(['base', 'symbols', 'dup_lines', 'word_length']) rule,
               unnest([base, symbols, dup_lines, word_length]) f from failed)
  group by all),
moments as (
  select rule, sum(n) total, sum(n * n) squares, count(*) hosts, sum(f) / sum(n) m, sum(f * f / n) square
  from rates group by rule),
spread as (
  select rule, m, case when total > squares / total
    then ((square - total * m * m) - (hosts - 1) * m * (1 - m)) / (total - squares / total) end v from moments),
prior as (
  select rule, m, greatest(2.0, least(1000.0, case when v > 0 then m * (1 - m) / v - 1 else 1000.0 end)) weight
  from spread),
verdicts as (
  select source, max((f + weight * m) / (n + weight)) <= 0.5 host_kept
  from rates join prior using (rule) group by source)
select doc_id, n_words::bigint n_words, word_chars, n_symbols::bigint n_symbols, n_dup_lines::bigint n_dup_lines,
       n_repeat_words::bigint n_repeat_words, base = 1 base_failed,
       greatest(base, symbols, dup_lines, word_length) = 0 and host_kept kept, host_kept
from failed join verdicts on failed.source is not distinct from verdicts.source
"""
