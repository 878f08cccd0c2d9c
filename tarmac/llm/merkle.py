"""op13: a Merkle manifest of a data set, with octopus multiproofs.

A row's leaf is the SHA-256 of its fields; the leaves of one group (a language), ordered
by id, form a binary tree whose lone last nodes are hashed alone; the groups' subroots,
ordered by group, form the tree of trees. Nodes have coordinates (tree, level, place).

Nodes are built in aligned blocks of ``2 ** LEVELS``, a few levels of every tree per pass,
and stored. Proofs are made per *leaf partition*, a run of at most ``LEAVES`` wanted
leaves of one tree. A partition computes the minimal union of the coordinates that it can
not derive from its own leaves (the multiproof), fetches those nodes once (one join),
derives the interior nodes that its leaves share, and expands every leaf's own proof
locally from the two. Any set of leaves may be wanted, not only neighbouring ones.

Defined results: a null field is ``-`` in the leaf; a null id comes first in its tree;
rows with one id are ordered by their leaves, equal rows are interchangeable; a null group
is a tree of its own and comes first; an empty table gives no rows; a tree of one leaf has
this leaf as its subroot, and a single subroot is the root. Texts are hashed whole, as
columns, in the JVM. Other columns of the table are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import ranked, staged, table
from tarmac.llm.sqlforms import crc32_sql

LEVELS = 12      # levels of a tree that one pass adds; a block has 2 ** LEVELS nodes
LEAVES = 20_000  # leaves of one leaf partition
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
TAMPERED = 7     # rows whose crc32(id) it divides are checked with a changed n_chars
TOP = -1         # the tree of the subroots

NODE = "tree long, level int, place long, digest string"


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def height(size: int) -> int:
    """Levels above the leaves of a tree of ``size`` leaves."""
    return max(int(size) - 1, 0).bit_length()


def leaf_digest(fields: dict[str, Column]) -> Column:
    """SHA-256 of the fields in order: ``-`` if null, else byte count, ``:`` and value."""
    one = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(*[one(c.cast("string")) for c in fields.values()]), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, leaf, shown): ``shown`` is the leaf of the row as a reader finds it,
    for tampered rows another one than ``leaf``."""
    fields = {c: F.col(c) for c in FIELDS}
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    changed = leaf_digest({**fields, "n_chars": F.col("n_chars") + 1})
    leaf = leaf_digest(fields)
    return docs.select("doc_id", "lang", leaf.alias("leaf"), F.when(hit, changed).otherwise(leaf).alias("shown"))


def _above(digests: Sequence[str]) -> list[str]:
    return [sha(*digests[i:i + 2]) for i in range(0, len(digests), 2)]


def _build_block(block: pa.Table) -> pa.Table:
    """The next levels above one aligned block of nodes: ``LEVELS`` of them, or as many as
    the tree still has."""
    order = np.argsort(block["place"].to_numpy())
    digests = block["digest"].take(pa.array(order)).to_pylist()
    place, level = int(block["place"][int(order[0])].as_py()), int(block["level"][0].as_py())
    out: dict[str, list] = {"level": [], "place": [], "digest": []}
    for _ in range(min(LEVELS, height(block["size"][0].as_py()) - level)):
        digests, place, level = _above(digests), place >> 1, level + 1
        out["level"] += [level] * len(digests)
        out["place"] += range(place, place + len(digests))
        out["digest"] += digests
    tree = [block["tree"][0].as_py()] * len(out["level"])
    return pa.table({"tree": pa.array(tree, pa.int64()), "level": pa.array(out["level"], pa.int32()),
                     "place": pa.array(out["place"], pa.int64()), "digest": pa.array(out["digest"], pa.string())})


def build(bottom: DataFrame) -> DataFrame:
    """All nodes (tree, level, place, digest) of trees with leaves (tree, place, size, digest)."""
    sizes = staged(bottom.groupBy("tree").agg(F.max("size").alias("size")), "merkle-sizes")
    top = sizes.agg(F.max("size")).first()[0] or 0
    at = bottom.select("tree", F.lit(0).alias("level"), "place", "digest", "size")
    parts, level = [at.drop("size")], 0
    while level < height(top):
        taller = at.filter(F.col("size") > (1 << level))
        nodes = (taller.groupBy("tree", F.shiftright("place", LEVELS).alias("block"))
                 .applyInArrow(_build_block, NODE))
        nodes = staged(nodes, "merkle-nodes")
        parts.append(nodes)
        level += LEVELS
        at = nodes.filter(F.col("level") == level).join(sizes, "tree")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def missing(places: Iterable[int], size: int) -> list[tuple[int, int]]:
    """The minimal union of (level, place) that the root of a tree of ``size`` leaves needs
    besides the leaves at ``places``: siblings that are neither given nor derivable."""
    known, wanted = np.unique(np.asarray(list(places), np.int64)), []
    for level in range(height(size)):
        beside = known ^ 1
        beside = beside[beside < -(-size >> level)]
        wanted += [(level, int(p)) for p in np.setdiff1d(beside, known)]
        known = np.unique(known >> 1)
    return wanted


COORDINATES = "tree long, run long, at_tree long, level int, place long"


def _coordinates(part: pa.Table) -> pa.Table:
    tree, run, trees = (part[c][0].as_py() for c in ("tree", "run", "trees"))
    size = part["size"][0].as_py()
    need = [(tree, *c) for c in missing(part["place"].to_numpy(), size)]
    need += [(TOP, *c) for c in missing([tree], trees)]
    need += [(tree, height(size), 0), (TOP, height(trees), 0)]  # what the proofs are held against
    at_tree, level, place = zip(*need)
    return pa.table({"tree": pa.array([tree] * len(need), pa.int64()), "run": pa.array([run] * len(need), pa.int64()),
                     "at_tree": pa.array(at_tree, pa.int64()), "level": pa.array(level, pa.int32()),
                     "place": pa.array(place, pa.int64())})


def _derived(level0: dict[int, str], fetched: dict[tuple[int, int], str], size: int) -> list[dict[int, str]]:
    """Per level the digests that follow from the leaves and the fetched nodes, these included."""
    levels, known = [], dict(level0)
    for level in range(height(size)):
        n = -(-size >> level)
        up: dict[int, str] = {}
        for p in sorted({q >> 1 for q in known}):
            for q in (2 * p, 2 * p + 1):
                if q < n and q not in known:
                    known[q] = fetched[level, q]
            up[p] = sha(known[2 * p], known.get(2 * p + 1, ""))
        levels.append(known)
        known = up
    return [*levels, known]


def _tails(levels: list[dict[int, str]], places: Iterable[int], above: str) -> dict[int, str]:
    """Per place the concatenated siblings from its level to the top, then ``above``."""
    wanted = [sorted(set(places))]
    for _ in levels[:-1]:
        wanted.append(sorted({p >> 1 for p in wanted[-1]}))
    tails = {0: above}
    for level, ps in zip(levels[-2::-1], wanted[-2::-1]):
        tails = {p: level.get(p ^ 1, "") + tails[p >> 1] for p in ps}
    return tails


def _fold(digest: str, place: int, levels: list[dict[int, str]]) -> str:
    for level in levels[:-1]:
        other = level.get(place ^ 1, "")
        digest = sha(other, digest) if place & 1 else sha(digest, other)
        place >>= 1
    return digest


PROVEN = ("leaf string, subroot string, root string, proof_sha256 string, "
          "folded_root string, verified boolean")


def _expand(part: pa.Table, nodes: pa.Table) -> pa.Table:
    """Every leaf's proof, from the partition's leaves and the nodes it fetched."""
    tree, trees, size = (part[c][0].as_py() for c in ("tree", "trees", "size"))
    given: dict[int, dict[tuple[int, int], str]] = {tree: {}, TOP: {}}
    for t, level, place, digest in zip(*(nodes[c].to_pylist() for c in ("at_tree", "level", "place", "digest"))):
        given[t][level, place] = digest
    places, leaf, shown = (part[c].to_pylist() for c in ("place", "digest", "shown"))
    levels = _derived(dict(zip(places, leaf)), given[tree], size)
    top = _derived({tree: levels[-1][0]}, given[TOP], trees)
    subroot, root = given[tree][height(size), 0], given[TOP][height(trees), 0]
    tails = _tails(levels, places, _tails(top, [tree], "")[tree])
    honest, folded = top[-1][0], []
    for p, was, now in zip(places, leaf, shown):
        folded.append(honest if was == now else _fold(_fold(now, p, levels), tree, top))
    n = len(places)
    return pa.table({"doc_id": part["doc_id"], "leaf": part["digest"],
                     "subroot": pa.array([subroot] * n, pa.string()), "root": pa.array([root] * n, pa.string()),
                     "proof_sha256": pa.array([sha(tails[p]) for p in places], pa.string()),
                     "folded_root": pa.array(folded, pa.string()),
                     "verified": pa.array([f == root for f in folded], pa.bool_())})


def proofs(wanted: DataFrame, nodes: DataFrame) -> DataFrame:
    """The proof of every wanted leaf (doc_id, tree, place, size, trees, digest, shown)."""
    wanted = wanted.withColumn("run", F.expr(f"place div {LEAVES}"))
    coordinates = wanted.groupBy("tree", "run").applyInArrow(_coordinates, COORDINATES)
    stored = nodes.withColumnRenamed("tree", "at_tree")
    fetched = coordinates.join(stored, ["at_tree", "level", "place"])
    return (wanted.groupBy("tree", "run").cogroup(fetched.groupBy("tree", "run"))
            .applyInArrow(_expand, f"doc_id {wanted.schema['doc_id'].dataType.simpleString()}, {PROVEN}"))


def manifest(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(leaves with their places, all nodes) of the table's trees, both stored."""
    rows = staged(leaves(docs), "merkle-leaves")
    placed = staged(ranked(rows, ["lang"], ["doc_id", "leaf"], "place", "size"), "merkle-placed")
    langs = staged(placed.groupBy("lang").agg(F.max("size").alias("leaves")), "merkle-groups")
    langs = staged(ranked(langs, [], ["lang"], "tree", "trees"), "merkle-trees")
    known = langs.select(F.col("lang").alias("_lang"), "tree", "trees")
    placed = staged(placed.join(known, F.col("lang").eqNullSafe(F.col("_lang")))
                    .select("doc_id", "tree", "place", "size", "trees", F.col("leaf").alias("digest"), "shown"),
                    "merkle-bottom")
    nodes = build(placed.select("tree", "place", "size", "digest"))
    level = F.when(F.col("leaves") > 1, F.length(F.bin(F.col("leaves") - 1))).otherwise(0)
    subroots = langs.select("tree", level.alias("level"), F.lit(0).cast("long").alias("place"), "trees")
    roots = nodes.join(subroots, ["tree", "level", "place"]).select(
        F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("place"), F.col("trees").alias("size"), "digest")
    return placed, nodes.unionByName(build(staged(roots, "merkle-subroots")))


def verified_manifest(docs: DataFrame) -> DataFrame:
    placed, nodes = manifest(docs)
    return proofs(placed, nodes)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified_manifest(table(spark, sf_dir, "documents"))


_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join("{%s}" % c for c in FIELDS) + ")"


def _leaf_sql(**other: str) -> str:
    return _LEAF.format(**{c: _FIELD.format(other.get(c, c)) for c in FIELDS})


def _tree_sql(name: str, leaves_sql: str) -> str:
    """Recursive tables: all nodes (tree, level, place, digest, n) above the given leaves."""
    return f"""
{name} AS (
  {leaves_sql}
  UNION ALL
  SELECT tree, level + 1, place // 2, digest, (n + 1) // 2 FROM (
    SELECT tree, level, place, n, sha256(digest || coalesce(
             lead(digest) OVER (PARTITION BY tree ORDER BY place), '')) AS digest
    FROM {name} WHERE n > 1) up
  WHERE place % 2 = 0)"""


ORACLE = f"""
WITH RECURSIVE rows AS (
  SELECT row_number() OVER () AS r, doc_id, lang, {_leaf_sql()} AS leaf,
         CASE WHEN {crc32_sql('doc_id::VARCHAR')} % {TAMPERED} = 0
              THEN {_leaf_sql(n_chars='(n_chars + 1)')} ELSE {_leaf_sql()} END AS shown
  FROM documents),
langs AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER () AS trees
          FROM (SELECT DISTINCT lang FROM rows) l),
placed AS (
  SELECT r, doc_id, tree, trees, leaf, shown,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS place,
         count(*) OVER (PARTITION BY tree) AS n
  FROM rows JOIN langs ON rows.lang IS NOT DISTINCT FROM langs.lang),
{_tree_sql('nodes', 'SELECT tree, 0 AS level, place, leaf AS digest, n FROM placed')},
tops AS (SELECT 0 AS tree, 0 AS level, nodes.tree AS place, digest, trees AS n
         FROM nodes JOIN langs USING (tree) WHERE nodes.n = 1),
{_tree_sql('crown', 'SELECT * FROM tops')},
paths AS (
  SELECT r, false AS above, tree, level, place, n, shown AS folded, '' AS proof, tree AS lang_tree
  FROM (SELECT *, 0 AS level FROM placed) p
  UNION ALL
  SELECT p.r, p.above OR p.n = 1, CASE WHEN p.n = 1 THEN 0 ELSE p.tree END,
         CASE WHEN p.n = 1 THEN 0 ELSE p.level + 1 END,
         CASE WHEN p.n = 1 THEN p.lang_tree ELSE p.place // 2 END,
         CASE WHEN p.n = 1 THEN (SELECT max(trees) FROM langs) ELSE (p.n + 1) // 2 END,
         CASE WHEN p.n = 1 THEN p.folded WHEN p.place % 2 = 1 THEN sha256(s.digest || p.folded)
              ELSE sha256(p.folded || coalesce(s.digest, '')) END,
         p.proof || CASE WHEN p.n = 1 THEN '' ELSE coalesce(s.digest, '') END, p.lang_tree
  FROM paths p LEFT JOIN (
    SELECT false AS above, tree, level, place, digest FROM nodes
    UNION ALL SELECT true, tree, level, place, digest FROM crown) s
    ON s.above = p.above AND s.tree = p.tree AND s.level = p.level AND s.place = xor(p.place, 1)
  WHERE p.n > 1 OR NOT p.above),
ends AS (SELECT r, folded, proof FROM paths WHERE above AND n = 1)
SELECT doc_id, leaf, subroots.digest AS subroot, roots.digest AS root, sha256(proof) AS proof_sha256,
       folded AS folded_root, folded = roots.digest AS verified
FROM placed JOIN ends USING (r)
JOIN (SELECT tree, digest FROM nodes WHERE n = 1) subroots USING (tree)
CROSS JOIN (SELECT digest FROM crown WHERE n = 1) roots
"""
