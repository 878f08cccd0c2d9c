import random
from collections import defaultdict

import numpy as np
import pyarrow as pa

from tarmac.llm import common, tokens
from tarmac.llm.common import components, native_components, running_sum


def test_components_equal_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)]
    edges += [(1000 + i, 1001 + i) for i in range(60)]         # a long chain
    edges += [(2000, 2001 + i) for i in range(80)]             # a hub
    edges += [(5, 5), (None, 3), (7, None)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {x: root(x) for x in parent}


def test_components_take_few_rounds(spark, monkeypatch):
    # Chains with ids in no order, hubs of small and of large ids, edges in 40 partitions.
    rng = random.Random(9)
    ids = rng.sample(range(100_000), 3000)
    edges = [(ids[i], ids[i + 1]) for i in range(1500) if i % 300]
    edges += [(-1, i) for i in ids[1600:2200]] + [(200_000, i) for i in ids[2200:2800]] + [(i, i) for i in ids[2900:]]
    rng.shuffle(edges)
    expected = {}
    for lo, hi in [(k + 1, k + 301) for k in range(0, 1500, 300)]:
        expected |= dict.fromkeys(ids[lo:hi], min(ids[lo:hi]))
    expected |= dict.fromkeys([-1, *ids[1600:2200]], -1)
    expected |= dict.fromkeys([200_000, *ids[2200:2800]], min(ids[2200:2800])) | {i: i for i in ids[2900:]}
    stored = []
    monkeypatch.setattr(common, "staged", lambda df, name, f=common.staged: (stored.append(name), f(df, name))[1])
    for kind in ("long", "string"):
        rows = edges if kind == "long" else [(f"{a + 1:07}", f"{b + 1:07}") for a, b in edges]
        df = spark.createDataFrame(rows, f"a {kind}, b {kind}").repartition(40)
        got = components(df).collect()
        assert len(got) == len(expected)
        assert {r.node: r.component for r in got} == (
            expected if kind == "long" else {f"{a + 1:07}": f"{b + 1:07}" for a, b in expected.items()})
    assert len(stored) <= 12, stored


def test_native_components_run_no_python(spark, monkeypatch):
    rng = random.Random(2)
    df = spark.createDataFrame([(rng.randrange(90), rng.randrange(90)) for _ in range(60)], "a long, b long")
    expected = {tuple(r) for r in components(df).collect()}
    monkeypatch.setattr(common, "_contracted", None)
    assert {tuple(r) for r in native_components(df).collect()} == expected


def test_blocks_of_edges_keep_what_is_joined(monkeypatch):
    rng = random.Random(6)
    edges = pa.table([[rng.randrange(400) for _ in range(300)], [rng.randrange(400) for _ in range(300)]], ["a", "b"])
    monkeypatch.setattr(common, "BLOCK_EDGES", 50)
    parts = pa.Table.from_batches(common._contracted(iter(edges.to_batches(max_chunksize=20))))
    whole = dict(zip(*(c.to_pylist() for c in common._stars(edges).columns)))
    again = dict(zip(*(c.to_pylist() for c in common._stars(parts).columns)))
    assert whole == again
    assert all(whole.get(a, a) == whole.get(b, b) <= min(a, b) for a, b in zip(*(c.to_pylist() for c in edges.columns)))
    assert all(root == node or whole.get(root, root) == root for node, root in whole.items())


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_running_sum_equals_plain_window(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(3), k // 7, k, rng.randrange(9)) for k in range(200)]
    df = spark.createDataFrame(rows, "g long, c long, k long, v long")
    sums, expected = defaultdict(int), {}
    for g, _, k, v in rows:
        expected[k] = sums[g]
        sums[g] += v
    assert {r.k: r.s for r in running_sum(df, ["g"], "c", ["k"], "v", "s").collect()} == expected


def test_word_hashes_follow_words():
    rng = random.Random(5)
    old = tokens.BLOCK
    texts = ["".join(rng.choice("aAbé \n\t 𝒳") for _ in range(rng.randrange(60))) for _ in range(300)]
    texts += [None, "", "x" * 5000, " " * 300]
    words = [w for t in texts for w in (t or "").encode().lower().split()]
    try:
        for block in (old, 64):
            tokens.BLOCK = block
            tokens._powers.clear()
            h, at = tokens.word_hashes(pa.array(texts), lower=True)
            assert np.diff(at).tolist() == [len((t or "").encode().split()) for t in texts]
            by_word = {}
            for w, x in zip(words, h.tolist()):
                assert by_word.setdefault(w, x) == x
            assert len(set(by_word.values())) == len(by_word)
    finally:
        tokens.BLOCK = old
        tokens._powers.clear()


def test_sliced_column_and_row_slices():
    column = pa.array(["a b", None, "c d e", "f"])[1:]
    h, at = tokens.word_hashes(column)
    assert at.tolist() == [0, 0, 3, 4] and len(h) == 4
    assert tokens.row_slices(column, 1) == [(0, 1), (1, 2), (2, 3)] or sum(
        b - a for a, b in tokens.row_slices(column, 1)) == 3
