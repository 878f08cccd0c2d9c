"""A root of stored tables with one current state that readers resolve without a version.

The state of all tables is one small manifest, ``<root>/_manifests/<sequence>.json``. A
commit writes the next sequence number by renaming a finished file, so readers see either
all of a change or nothing of it, a job that dies before its commit leaves the old state
current, and two writers cannot both follow the same state (:class:`CommitConflict`).

A table is a list of layers: folders of Parquet files that are never changed, each with the
files that still count. A change writes one new layer with the rows of the files it
touches and leaves those files out of the old layers; all other files stay where they are.
Dropping a partition only leaves files out. Manifests hold file names, not rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.schema import KeyedTable
from tarmac.sources.files import write_table

FILE = "_file"


class CommitConflict(RuntimeError):
    """Another writer has committed since the state that a change was made from."""


@dataclass(frozen=True)
class Layer:
    path: str                # folder below <root>/<table>
    files: tuple[str, ...]   # names below the folder, partition directories included


@dataclass(frozen=True)
class State:
    sequence: int
    tables: dict[str, tuple[Layer, ...]]


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _listed(self, path: str, recursive: bool = True) -> list[str]:
        """Files below a folder, as names relative to it (none if it is absent)."""
        fs, p = self._path(path)
        if not fs.exists(p):
            return []
        base, out, found = fs.makeQualified(p).toUri().getPath() + "/", [], fs.listFiles(p, recursive)
        while found.hasNext():
            out.append(found.next().getPath().toUri().getPath().removeprefix(base))
        return sorted(n for n in out if not any(part[:1] in "_." for part in n.split("/")))

    def state(self, sequence: int | None = None) -> State:
        """The current state, or an earlier one by its number."""
        names = [n for n in self._listed(f"{self.root}/_manifests") if n.endswith(".json")]
        if sequence is None and not names:
            return State(0, {})
        name = names[-1] if sequence is None else f"{sequence:012d}.json"
        fs, p = self._path(f"{self.root}/_manifests/{name}")
        stream = fs.open(p)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        tables = {t: tuple(Layer(x["path"], tuple(x["files"])) for x in layers)
                  for t, layers in json.loads(text).items()}
        return State(int(name.removesuffix(".json")), tables)

    def commit(self, base: State, changes: dict[str, Iterable[Layer]]) -> State:
        """Makes ``changes`` (whole layer lists of some tables) to ``base`` current."""
        after = State(base.sequence + 1, {**base.tables, **{t: tuple(x for x in layers if x.files)
                                                            for t, layers in changes.items()}})
        text = json.dumps({t: [{"path": x.path, "files": x.files} for x in layers]
                           for t, layers in after.tables.items()})
        fs, tmp = self._path(f"{self.root}/_manifests/.{uuid.uuid4().hex}")
        out = fs.create(tmp)
        out.write(bytearray(text.encode()))
        out.close()
        _, to = self._path(f"{self.root}/_manifests/{after.sequence:012d}.json")
        if fs.exists(to) or not fs.rename(tmp, to):
            fs.delete(tmp, False)
            raise CommitConflict(f"state {after.sequence} exists already")
        return after

    def write(self, df: DataFrame, table: KeyedTable, keep_order: bool = False,
              observe: tuple | None = None) -> Layer:
        """A new layer with the rows of ``df``, not current before a commit. ``keep_order``:
        ``df`` is a narrow change of stored rows, whose distribution is kept (no shuffle)."""
        name = f"layer-{uuid.uuid4().hex[:12]}"
        path = f"{self.root}/{table.name}/{name}"
        write_table(df, path, table, observe, keep_layout=keep_order)
        return Layer(name, tuple(n for n in self._listed(path) if n.endswith(".parquet")))

    def create(self, *tables: KeyedTable) -> State:
        """Tables that the current state lacks begin empty; others stay as they are."""
        now = self.state()
        new = {t.name: () for t in tables if t.name not in now.tables}
        return self.commit(now, new) if new else now

    def replace(self, dfs: dict[KeyedTable, DataFrame]) -> State:
        """Full replace: every given table gets the rows of its frame, all at once."""
        base = self.state()
        return self.commit(base, {t.name: (self.write(df, t),) for t, df in dfs.items()})

    def scan(self, table: KeyedTable, state: State | None = None, only: Iterable[str] | None = None) -> DataFrame:
        """The table's rows with the file each is in (``_file``, as layer/name). ``only``: the
        files to read."""
        wanted = None if only is None else set(only)
        parts = []
        for layer in (state or self.state()).tables[table.name]:
            names = [n for n in layer.files if wanted is None or f"{layer.path}/{n}" in wanted]
            if names:
                folder = f"{self.root}/{table.name}/{layer.path}"
                df = (self.spark.read.schema(table.schema).option("basePath", folder)
                      .parquet(*[f"{folder}/{n}" for n in names]))
                at = F.concat(F.lit(f"{layer.path}/"), F.substring_index("_metadata.file_path", f"/{layer.path}/", -1))
                parts.append(df.select(*table.columns, at.alias(FILE)))
        if not parts:
            return self.spark.createDataFrame([], table.schema).withColumn(FILE, F.lit(None).cast("string"))
        return reduce(DataFrame.unionByName, parts)

    def read(self, table: KeyedTable, columns: list[str] | None = None, state: State | None = None) -> DataFrame:
        return self.scan(table, state).select(*(columns or table.columns))

    def partitions(self, table: KeyedTable, state: State | None = None) -> dict[str, list[str]]:
        """Directory values of a partitioned table and their files, from the manifest alone."""
        (column,) = table.partition_by
        out: dict[str, list[str]] = {}
        for layer in (state or self.state()).tables[table.name]:
            for n in layer.files:
                value = unquote(n.split("/")[0].removeprefix(f"{column}="))
                out.setdefault(value, []).append(f"{layer.path}/{n}")
        return out

    def drop_partition(self, table: KeyedTable, value: str) -> State:
        """D-04 as metadata: the files of one partition value no longer count."""
        base = self.state()
        gone = self.partitions(table, base).get(value, [])
        return self.commit(base, {table.name: without(base.tables[table.name], gone)}) if gone else base


def without(layers: Iterable[Layer], files: Iterable[str]) -> tuple[Layer, ...]:
    gone = {unquote(f) for f in files}
    return tuple(Layer(x.path, tuple(n for n in x.files if unquote(f"{x.path}/{n}") not in gone)) for x in layers)


def touched(rows: DataFrame, *metrics) -> list:
    """One row per file that holds any of ``rows`` (of :meth:`Warehouse.scan`), with metrics:
    as many rows as files, never as rows."""
    return rows.groupBy(FILE).agg(*(metrics or [F.count(F.lit(1)).alias("rows")])).collect()

