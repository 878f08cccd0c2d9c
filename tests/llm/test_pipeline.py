import re
from collections import Counter

import pyarrow.parquet as pq
import pytest
from llm_cases import DOCS, docs, no_docs
from test_decontam_neardup import plain_groups
from test_langid_pii import plain_base

import __spark_entry__ as entry
import corpus_pipeline
from tarmac.llm import decontam
from tarmac.llm.common import staged, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    df, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        df = staged(stage(spark, df, SF), "test-pipeline")
        out.append(df)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_stages_equal_plain_versions(spark, outputs):
    given = table(spark, SF, "documents")
    language, dedup, clean, redacted, mix = outputs
    assert all(df.columns == given.columns for df in outputs[:-1])
    start = texts(given)
    first = texts(language)
    assert first == {i: t for i, t in start.items() if t and any(map(str.isalpha, t))}
    second = texts(dedup)
    assert set(second) == {i for i, (_, c) in plain_groups(first).items() if i == c}
    leaked = {r.doc_id for r in decontam.leaks(dedup, table(spark, SF, "benchmark")).collect()}
    third = texts(clean)
    assert set(third) == set(second) - leaked and leaked
    fourth = texts(redacted)
    assert set(fourth) == set(third)
    for i, t in third.items():
        if not re.search("[0-9@]", t):
            assert fourth[i] == t
        for kind, a, b in plain_base(t):
            assert t[a:b] not in fourth[i]
    assert all(r.n_chars == len(r.text) for r in redacted.collect())
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in fourth.items()}
    got = mix.collect()
    assert {r.doc_id: r.size for r in got} == size and all(r.taken <= 3 * r.size for r in got)


def test_run_is_registered_and_agrees(spark, outputs):
    got = Counter(map(tuple, entry.queries()["pipeline"](spark, SF).collect()))
    assert got == Counter(map(tuple, outputs[-1].collect()))
    assert "pipeline" not in entry.oracle_sql()
    assert [k for k, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "redact_pii",
                                                      "mix_sources"]


def test_stages_take_odd_and_empty_tables(spark):
    for given, n in ((docs(spark), 5), (no_docs(spark), 0)):
        df = given
        for name, stage in corpus_pipeline.STAGES[:-1]:
            df = staged(stage(spark, df, SF), "test-odd")
            assert df.columns == given.columns
        assert df.count() >= n and df.count() <= len(DOCS)
        corpus_pipeline.STAGES[-1][1](spark, df, SF).collect()
    bench = pq.read_table(f"{SF}/benchmark.parquet").num_rows
    assert bench > 0
