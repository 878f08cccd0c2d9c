import random
import re
from collections import defaultdict
from itertools import combinations

import pyarrow.parquet as pq
from llm_cases import DOCS, docs, no_docs, ordered
from pyspark.sql import functions as F

from tarmac.llm import decontam, neardup, tiles
from tarmac.llm.common import table

SF = "/root/testdata/sf0.01"
ITEMS = "item_id long, text string, doc_id int"


def words(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n)]


def test_planted_passages_with_replaced_words(spark):
    rng = random.Random(1)
    items = [(k, " ".join(words(rng, rng.randrange(14, 60))), k) for k in range(40)]
    items += [(900, "too short to tell", 1), (901, None, 1), (902, "", 1), (None, " ".join(words(rng, 20)), 1)]
    data, expected, clean = [], set(), set()
    for d in range(200):
        text = words(rng, rng.randrange(30, 200))
        if d % 3 == 0:
            k = rng.randrange(40)
            passage = items[k][1].split()
            for at in range(5, len(passage) - 4, 9):       # every ninth word is another one
                passage[at] = "zzz"
            at = rng.randrange(len(text))
            text[at:at] = [w.upper() if rng.random() < .2 else w for w in passage]
            expected.add((d, k))
        elif d % 3 == 1:
            clean.add(d)
            text[4:4] = items[rng.randrange(40)][1].split()[:7]  # too little to count
        data.append((d, ", ".join(text), None))
    got = {(r.doc_id, r.item_id): r for r in decontam.leaks(
        spark.createDataFrame(data, "doc_id long, text string, item_id string"),
        spark.createDataFrame(items, ITEMS)).collect()}
    assert set(got) == expected
    assert all(r.matched >= 0.8 * r.overlap and r.matched >= 12 for r in got.values())
    assert not {d for d, _ in got} & clean


def test_every_substitution_up_to_the_identity():
    import numpy as np
    rng = np.random.default_rng(4)
    hashes = lambda n: rng.integers(1, 1 << 63, n, dtype=np.uint64)
    for n, others in [(8, 1), (9, 1), (10, 2), (11, 2), (12, 2), (13, 2), (14, 2), (15, 3), (16, 3), (19, 3), (20, 4)]:
        item, before = hashes(n), hashes(9)
        index = decontam.build_index([5], [item])
        texts = []
        for places in combinations(range(n), others):
            text = item.copy()
            text[list(places)] = hashes(others)
            texts.append(np.concatenate([before, text, hashes(5)]))
        at = np.cumsum([0, *map(len, texts)])
        got = decontam.find_overlaps(index, np.concatenate(texts), at)
        assert [g[:3] for g in got] == [(k, 5, n - others) for k in range(len(texts))], (n, others)
    for n in (60, 200):  # random ones in long items, and one too many everywhere
        item = hashes(n)
        index = decontam.build_index([5], [item])
        for _ in range(200):
            text = item.copy()
            text[rng.choice(n, n // 5, replace=False)] = hashes(n // 5)
            assert decontam.find_overlaps(index, text, np.array([0, n]))[0][2] >= n * 4 // 5
        text = item.copy()
        text[2::3] = hashes(len(text[2::3]))
        assert not decontam.find_overlaps(index, text, np.array([0, n]))


def test_items_of_few_tokens_match_whole(spark):
    items = [(n, " ".join(f"w{n}x{k}" for k in range(n)), 0) for n in range(1, 8)]
    data = [(n, f"before {t.upper()}, after", None) for n, t, _ in items]
    data += [(100 + n, "before " + t.rsplit(" ", 1)[0] + " after", None) for n, t, _ in items if n > 1]
    got = decontam.leaks(spark.createDataFrame(data, "doc_id long, text string, item_id string"),
                         spark.createDataFrame(items, ITEMS)).collect()
    assert sorted((r.doc_id, r.item_id, r.matched, r.overlap, r.position) for r in got) == [
        (n, n, n, n, 1) for n in range(1, 8)]


def test_long_items_and_null_ids(spark):
    rng = random.Random(8)
    word = lambda n: [f"w{rng.randrange(50_000)}" for _ in range(n)]
    long, short, other = word(9000), word(30), word(30)
    changed = [w if k % 10 else "x" for k, w in enumerate(long)]
    bench = spark.createDataFrame([(None, " ".join(short)), (-1, " ".join(other)), (7, " ".join(long))],
                                  "item_id long, text string")
    texts = [(1, " ".join(word(50) + long + word(9))), (2, " ".join(changed)), (3, " ".join(short)),
             (4, " ".join(other)), (5, " ".join(word(3) + long[5000:5040])), (6, " ".join(word(400)))]
    got = decontam.leaks(spark.createDataFrame(texts, "doc_id long, text string"), bench).collect()
    assert ordered(map(tuple, got)) == ordered([
        (1, 7, 9000, 9000, 50, 9000), (2, 7, 8100, 8999, 1, 9000), (3, None, 30, 30, 0, 30),
        (4, -1, 30, 30, 0, 30), (5, 7, 40, 40, 3, 9000)])


def test_blocks_change_nothing(spark, monkeypatch):
    d, b = table(spark, SF, "documents").limit(300), table(spark, SF, "benchmark")
    whole = ordered(map(tuple, decontam.leaks(d, b).collect()))
    monkeypatch.setattr(decontam, "BLOCK_TOKENS", 300)
    assert ordered(map(tuple, decontam.leaks(d, b).collect())) == whole and whole


def test_equals_plain_search(spark):
    token = lambda t: re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (t or "").lower())
    at = defaultdict(set)
    for i, t in zip(*[c.to_pylist() for c in pq.read_table(f"{SF}/benchmark.parquet", columns=["item_id", "text"])]):
        w = token(t)
        for k in range(len(w) - 11):
            at[tuple(w[k:k + 12])].add(i)
    expected = set()
    for i, t in zip(*[c.to_pylist() for c in pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"])]):
        w = token(t)
        for k in range(len(w) - 11):
            expected |= {(i, x) for x in at.get(tuple(w[k:k + 12]), ())}
    assert {(r.doc_id, r.item_id) for r in decontam.query(spark, SF).collect()} == expected


def test_decontam_odd_rows(spark):
    text = DOCS[0][1]
    bench = spark.createDataFrame([(1, text, 1)], ITEMS)
    left = decontam.decontaminated(docs(spark), bench)
    assert left.columns == docs(spark).columns
    assert ordered(map(tuple, left.collect())) == ordered(d for d in DOCS if not (d[1] or "").startswith(text))
    assert decontam.leaks(no_docs(spark), bench).count() == 0
    assert decontam.leaks(docs(spark), bench.limit(0)).count() == 0
    assert decontam.decontaminated(docs(spark), bench.limit(0)).count() == len(DOCS)


def plain_groups(texts):
    sets, parent = {}, {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        if w:
            sets[i] = frozenset(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else frozenset([tuple(w)])
    index, common = defaultdict(list), defaultdict(int)
    for i, s in sets.items():
        for x in s:
            index[x].append(i)
    for ids in index.values():
        for a in range(len(ids)):
            for b in range(a):
                common[ids[b], ids[a]] += 1
    parent = {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {i: (len(sets.get(i, ())), root(i)) for i in texts}


def test_groups_equal_all_pairs(spark):
    texts = dict(zip(*[c.to_pylist() for c in pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"])]))
    got = neardup.query(spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain_groups(texts)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_copies_of_any_shape(spark):
    rng = random.Random(9)
    texts, n = {}, 0
    for g in range(60):
        base = words(rng, rng.randrange(6, 120))
        for _ in range(rng.choice([1, 2, 5, 12])):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 25)):
                copy[rng.randrange(len(copy))] = "changed"
            texts[n] = " ".join(copy)
            n += 1
    order = list(texts)
    rng.shuffle(order)
    data = [(i, texts[i]) for i in order]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(
        spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got == plain_groups(texts)


def test_links_between_documents_that_are_no_centre(spark):
    rng = random.Random(21)
    base, texts = words(rng, 150), {}
    for g in range(60):  # pairs linked inside, close to but under the threshold outside
        one = list(base)
        for p in rng.sample(range(150), 5):
            one[p] = f"x{g}y{p}"
        two = list(one)
        two[rng.randrange(150)] = f"z{g}"
        texts[g], texts[1000 - g] = " ".join(one), " ".join(two)
    expected = plain_groups(texts)
    assert len({c for _, c in expected.values()}) > 40
    data = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    # As if all documents met in the same twelve buckets: stars alone miss most links.
    sizes = neardup.sketches(data).select("doc_id", F.col("n_shingles").alias("n"))
    members = sizes.select(F.explode(F.sequence(F.lit(1), F.lit(12))).alias("key"), "doc_id",
                           F.lit(120).alias("members"), F.lit(0).alias("lo"), F.lit(1000).alias("hi"))
    first = neardup.confirmed(neardup.star_candidates(members), data, sizes)
    assert first.count() == 1
    found = neardup.linked_groups(sizes.select(F.col("doc_id").alias("node")), members, data, sizes,
                                  first.limit(0)).collect()
    assert dict(map(tuple, found)) == {i: c for i, (_, c) in expected.items()}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(data).collect()}
    assert got == expected


def test_large_open_buckets_are_compared_whole(spark, monkeypatch):
    rng = random.Random(31)
    base, texts = words(rng, 150), {}
    for g in range(40):  # every shingle is in about half of the documents
        code = [rng.randrange(2) for _ in range(30)]
        for k in range(2):
            for p in rng.sample(range(30), 3 * k):
                code[p] = 1 - code[p]
            texts[2 * g + k] = " ".join(f"{w}{code[p // 5]}" if p % 5 == 2 else w for p, w in enumerate(base))
    expected = plain_groups(texts)
    assert len({c for _, c in expected.values()}) == 40
    data = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sizes = neardup.sketches(data).select("doc_id", F.col("n_shingles").alias("n"))
    members = sizes.select(F.lit(1).alias("key"), "doc_id", F.lit(80).alias("members"))
    none = sizes.select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b")).limit(0)
    monkeypatch.setattr(neardup, "star_candidates", lambda members: none)  # as if stars had met no linked pair
    for rows in (2048, 16):  # one tile, many tiles
        monkeypatch.setattr(tiles, "BLOCK_ROWS", rows)
        found = neardup.linked_groups(sizes.select(F.col("doc_id").alias("node")), members, data, sizes, none).collect()
        assert dict(map(tuple, found)) == {i: c for i, (_, c) in expected.items()}


def test_signature_similarity_is_unbiased():
    import numpy as np
    rng = np.random.default_rng(3)
    for size in (12, 80, 900):
        agree = []
        for _ in range(60):
            pool = rng.integers(0, 1 << 63, size + size // 7 * 2, dtype=np.uint64)
            extra = size // 7
            a, b = np.sort(pool[:size + extra]), np.sort(np.concatenate([pool[:size], pool[size + extra:]]))
            agree.append((neardup.one_permutation(a) == neardup.one_permutation(b)).mean() - size / len(pool))
        assert abs(np.mean(agree)) < 0.05


def test_neardup_odd_rows(spark):
    got = neardup.near_duplicates(docs(spark)).collect()
    assert len(got) == len(DOCS)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(tuple(r))
    assert by[1] == [(1, 76, 1, True)] * 2 and by[2] == [(2, 76, 1, False)]
    assert by[3] == [(3, 0, 3, True)] and by[5] == [(5, 0, 5, True)] and by[6] == [(6, 1, 6, True)]
    assert sorted(x[1:] for x in by[None]) == [(0, None, True), (78, None, True)]
    left = neardup.deduplicated(docs(spark))
    assert left.columns == docs(spark).columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == [1, 3, 4, 5, 6, 7, 8, 9]
    twice = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (2, "a b", "y")], "doc_id long, text string, source string")
    assert sorted(map(tuple, neardup.deduplicated(twice).collect())) == [(1, None, "x"), (2, "a b", "y")]
    assert neardup.near_duplicates(no_docs(spark)).count() == 0 == neardup.deduplicated(no_docs(spark)).count()
