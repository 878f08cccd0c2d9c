import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
from llm_cases import DOCS, docs, no_docs, ordered
from test_decontam_neardup import words

from oracle_check import compare, duck
from tarmac.llm import merkle, ngramjoin, registry, tiles, trie

SF = "/root/testdata/sf0.001"


def test_queries_equal_their_sql(spark):
    con = duck(SF)
    for name in ("op11_prefix_trie", "op12_ngram_join", "op13_merkle_manifest"):
        result = compare(registry.QUERIES[name](spark, SF), con, registry.ORACLE[name])
        assert result["columns_match"] and result["values_match"] and result["spark_rows"] > 0, (name, result)


# Conversation trie

def plain_trie(rows):
    """Nodes by the contract, conversation by conversation and turn by turn."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(ts)] for c, ts in own.items()}
    members, stops = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        turns = own.get(c - int(np.fmod(c, 5)), [])[:h] + own[c][h:]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        stops[tuple(turns)].append(c)
    children = defaultdict(int)
    for key in members:
        if key:
            children[key[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for key, m in members.items():
        for d in range(len(key) + 1):
            leaves[key[:d]] += not children[key]
            saved[key[:d]] += (len(m) - 1) * len(key[-1][1].encode()) if key else 0
    return sorted((m[0], len(key), members[key[:-1]][0] if key else -1, len(m), children[key], leaves[key], saved[key],
                   hashlib.sha256(",".join(map(str, stops[key])).encode()).hexdigest()) for key, m in members.items())


def got_trie(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, d int, bytes string")
    return sorted(tuple(-1 if v is None else v for v in r) for r in trie.trie(df).collect())


def padded(rows):
    return [(*r, 1, "x") for r in rows]


def test_trie_equals_plain_version_with_and_without_a_crown(spark, monkeypatch):
    rng = random.Random(3)
    rows = []
    for c in range(120):
        for t in range(rng.choice([0, 1, 3, 9, 14])):
            rows.append((c, t, rng.choice(["user", "é"]), rng.choice("ab") if t < 8 else rng.choice(["x", None])))
    rows += [(500 + c, t, "user", "long" if t < 25 else str(c)) for c in range(12) for t in range(30)]  # one long beginning
    rows += [(900 + c, t, "user", "same") for c in range(30) for t in range(12)]                        # copies
    rows += [(None, 1, "user", "lost"), (-7, None, None, None), (-7, 2, "a", "b"), (-7, 2, "a", "b"), (7, None, "", "")]
    rng.shuffle(rows)
    expected = plain_trie(rows)
    for shard, chunk in ((trie.SHARD_ROWS, trie.CHUNK), (40, 8)):
        monkeypatch.setattr(trie, "SHARD_ROWS", shard)
        monkeypatch.setattr(trie, "CHUNK", chunk)
        assert got_trie(spark, padded(rows)) == expected


def test_trie_of_odd_tables(spark):
    assert got_trie(spark, []) == []
    assert got_trie(spark, padded([(None, 0, "a", "b")])) == []
    # Conversation 1 borrows from 0, which is absent: its first turns go, the root stays.
    h = zlib.crc32(b"1") % 9
    rows = [(1, t, "user", "x" * 50_000) for t in range(max(h, 1))]
    assert got_trie(spark, padded(rows)) == plain_trie(rows)


def test_node_table_is_a_verified_bijection():
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 1 << 63, (5000, 2), dtype=np.uint64)
    keys[1:50, 0] = keys[0, 0]  # equal first words
    table = trie.NodeTable(keys)
    assert sorted(table.slots(keys)) == list(range(5000))
    assert (table.slots(rng.integers(0, 1 << 63, (5000, 2), dtype=np.uint64)) == -1).all()
    assert len(trie.NodeTable(keys[:0]).slots(keys[:3])) == 3


# N-gram join

def plain_join(texts, width=3, num=90):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + width]) for k in range(max(len(w) - width + 1, min(len(w), 1)))}
    parent = {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            c = len(sets[a] & sets[b])
            if c and 100 * c >= num * (len(sets[a]) + len(sets[b]) - c):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in texts}


def near_copies(rng):
    texts, n = {}, 0
    for _ in range(50):
        base = words(rng, rng.choice([1, 2, 4, 9, 15, 30, 60, 150, 400]))
        for _ in range(rng.choice([1, 2, 4, 9])):
            copy = list(base)
            for _ in range(rng.randrange(0, 2 + len(base) // 40)):
                at = rng.randrange(len(copy))
                copy[at:at + rng.randrange(2)] = [rng.choice(["new", "other"])]
            texts[n] = " ".join(copy)
            n += 1
    return texts


def test_join_equals_all_pairs_in_one_tile_and_in_many(spark, monkeypatch):
    texts = near_copies(random.Random(8))
    expected = plain_join(texts)
    assert 60 < len({c for _, c in expected.values()}) < len(texts)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for rows in (2048, 3):
        monkeypatch.setattr(tiles, "BLOCK_ROWS", rows)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngramjoin.joined(df).collect()} == expected


def test_every_link_shares_a_slice():
    rng = np.random.default_rng(2)
    num, den = ngramjoin.THRESHOLD
    for n in [10, 11, 17, 26, 30, 59, 60, 61, 140, 300, 1500]:
        for _ in range(60):
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
            apart = (den - num) * 2 * n // (den + num)  # as many differing shingles as a link allows, or fewer
            gone = rng.integers(0, apart // 2 + 1)
            b = np.sort(np.concatenate([rng.permutation(a)[gone:], rng.integers(0, 1 << 63, apart // 2, dtype=np.uint64)]))
            if den * tiles.overlap(a, b) >= num * (len(a) + len(b) - tiles.overlap(a, b)) and len(a) != tiles.overlap(a, b):
                assert np.intersect1d(ngramjoin.slice_keys(a), ngramjoin.slice_keys(b)).size


def test_bitmaps_never_count_more_than_differs():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 5000, n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for n in rng.integers(1, 900, 60)]
    maps = tiles.Bitmaps([tiles.parity_bitmap(s) for s in sets])
    for i in range(60):
        others = np.arange(60)
        apart = maps.apart(i, others)
        assert all(apart[j] <= len(np.setxor1d(sets[i], sets[j])) for j in others)


def test_join_odd_rows(spark):
    by = defaultdict(list)
    for r in ngramjoin.joined(docs(spark)).collect():
        by[r.doc_id].append(tuple(r))
    assert sum(map(len, by.values())) == len(DOCS)
    assert by[1] == [(1, 78, 1)] * 2 and by[2] == [(2, 78, 1)]
    assert by[3] == [(3, 0, 3)] and by[4] == [(4, 0, 4)] and by[5] == [(5, 0, 5)] and by[6] == [(6, 1, 6)]
    assert sorted(x[1:] for x in by[None]) == [(0, None), (80, None)]
    assert ngramjoin.joined(no_docs(spark)).count() == 0


# Merkle manifest

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows):
    def leaf(doc_id, text, lang, source, n_chars):
        return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])

    def tree(nodes):  # levels, leaves first
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
        return levels

    def fold(digest, at, levels):
        proof = ""
        for level in levels[:-1]:
            other = level[at ^ 1] if at ^ 1 < len(level) else ""
            proof += other
            digest, at = sha(other, digest) if at & 1 else sha(digest, other), at >> 1
        return digest, proof

    langs = defaultdict(list)
    for r in rows:
        langs[r[2]].append(r)
    names = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in names:
        langs[lang].sort(key=lambda r: (r[0] is not None, r[0], leaf(*r)))
        trees[lang] = tree([leaf(*r) for r in langs[lang]])
    top, out = tree([trees[lang][-1][0] for lang in names]), []
    for k, lang in enumerate(names):
        for at, r in enumerate(langs[lang]):
            shown = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None:
                shown = (*r[:4], r[4] + 1)
            low, p1 = fold(leaf(*shown), at, trees[lang])
            root, p2 = fold(low, k, top)
            out.append((r[0], leaf(*r), trees[lang][-1][0], top[-1][0], sha(p1 + p2), root, root == top[-1][0]))
    return out


def test_manifest_equals_plain_version(spark):
    assert ordered(map(tuple, merkle.verified_manifest(docs(spark)).collect())) == ordered(
        plain_manifest([r[:5] for r in DOCS]))
    assert merkle.verified_manifest(no_docs(spark)).count() == 0
    one = [(5, "t", None, "s", 1)]
    df = spark.createDataFrame(one, "doc_id long, text string, lang string, source string, n_chars long")
    assert list(map(tuple, merkle.verified_manifest(df).collect())) == plain_manifest(one)


def test_manifest_of_several_blocks_and_leaf_partitions(spark):
    rows = [(i * 3 % 45_007, f"text {i}", "en" if i % 9 else ("é" if i % 2 else None), None, i) for i in range(45_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = merkle.verified_manifest(df).collect()
    assert ordered(map(tuple, got)) == ordered(plain_manifest(rows))
    assert 0.1 < sum(not r.verified for r in got) / len(got) < 0.2


def test_multiproof_is_enough_and_minimal():
    rng = random.Random(6)
    for _ in range(60):
        size = rng.randrange(1, 200)
        leaves = [sha(str(i)) for i in range(size)]
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append(merkle._above(levels[-1]))
        places = rng.sample(range(size), rng.randrange(1, size + 1))
        need = merkle.missing(places, size)
        assert len(set(need)) == len(need)
        fetched = {c: levels[c[0]][c[1]] for c in need}
        derived = merkle._derived({p: leaves[p] for p in places}, fetched, size)
        assert derived[-1] == {0: levels[-1][0]}
        # No fetched node is above a given leaf or below another fetched one.
        above = {(h, p >> h) for p in places for h in range(len(levels))}
        assert not above & set(need)
        assert all((h + k, p >> k) not in fetched for h, p in need for k in range(1, len(levels) - h))


def test_proofs_of_chosen_leaves_only(spark):
    rows = [(i, f"t{i}", "en", None, i) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    placed, nodes = merkle.manifest(df)
    some = merkle.proofs(placed.filter("doc_id % 37 = 5"), nodes).collect()
    expected = {r[0]: r for r in plain_manifest(rows)}
    assert len(some) == 8 and all(tuple(r) == expected[r.doc_id] for r in some)
