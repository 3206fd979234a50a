"""Stored tables that change by published versions.

A write puts its files into a new folder below data/ and touches nothing that is there. A manifest names, for each
partition, the folders that hold its rows; the version is published by one rename of that manifest to the next number,
which fails if another writer has taken it. So a reader sees a version whole or not at all, a writer that dies leaves files
that nothing names, and of two writers on one version one fails and may start again.

    path/data/__w=<write>/<partition>/part-*.parquet
    path/versions/<number>.json

The rename is atomic where the file system's is (HDFS and its like). The local file system's rename replaces its goal, so
there the goal is looked for first, under a lock of this process.
"""

from __future__ import annotations

import json
import threading
import uuid
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.operators.quality import RulesFailed, require
from driftline.sources.store import written

WRITE = "__w"
_LOCK = threading.Lock()


class Conflict(RuntimeError):
    """Another writer has published a version since the one that this write was made on."""


class Table:
    """A table at `path`. Each write is one published version; see create(), open(), merge(), replace_partitions()."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._jvm, self._conf = jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._at("").getFileSystem(self._conf)

    @staticmethod
    def create(df: DataFrame, path: str, keys: list[str], partition_by: list[str] | None = None, rules: dict[tuple[str, str], Column] | None = None) -> Table:
        """Version 0: the rows of df, which must hold one row for each value of keys. Partition columns must be keys or
        follow from them, so that a key never changes its partition."""
        table = Table(df.sparkSession, path)
        if table.versions():
            raise Conflict(f"{path} is a table already")
        parts = partition_by or []
        head = {"version": -1, "keys": keys, "partition_by": parts, "schema": T.StructType([T.StructField(f.name, f.dataType) for f in df.schema]).jsonValue(), "parts": {}, "batches": {}}
        table._publish(head, table._write(df, head, rules or {})[0], add=False)
        return table

    # --- reading ---

    def versions(self) -> list[int]:
        found = self._fs.globStatus(self._at("versions/*.json"))
        return sorted(int(s.getPath().getName().split(".")[0]) for s in found or [])

    def manifest(self, version: int | None = None) -> dict:
        known = self.versions()
        if not known or (version is not None and version not in known):
            raise ValueError(f"{self.path} has no version {'' if version is None else version}")
        stream = self._fs.open(self._at(f"versions/{known[-1] if version is None else version:010d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (default: the last). Partition columns prune folders."""
        return self._rows(self.manifest(version))

    def _rows(self, m: dict, only: set[str] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(m["schema"])
        folders = [f"{self.path}/data/{w}/{p}".rstrip("/") for p, writes in m["parts"].items() if only is None or p in only for w in writes]
        if not folders:
            return self.spark.createDataFrame([], schema)
        whole = T.StructType([*schema, T.StructField(WRITE, T.StringType())])
        return self.spark.read.schema(whole).option("basePath", f"{self.path}/data").parquet(*folders).select(*schema.names)

    # --- writing ---

    def merge(self, source: DataFrame, update: bool = True, insert: bool = True, batch: tuple[str, int] | None = None, rules: dict[tuple[str, str], Column] | None = None) -> int:
        """Publish the table with the rows of source put in by key, and return the version.

        update: rows of known keys are replaced. insert: rows of new keys are added. Only partitions that source touches
        are read and written again; where nothing is updated they are not, and the new rows' folder is added to them.
        source is written once and must have one row for each key, or ValueError. batch: (writer's name, number): a number that the manifest
        has for that writer, or one below it, changes nothing, so a batch that runs twice counts once. A source without
        rows publishes nothing. Null keys are equal.
        """
        m = self.manifest()
        keys, parts = m["keys"], m["partition_by"]
        source = written(source.select(*T.StructType.fromJson(m["schema"]).names))  # whole, so that a stream's state is kept
        if batch and m["batches"].get(batch[0], -1) >= batch[1]:
            return m["version"]
        if not source.groupBy(*keys).count().filter("count > 1").isEmpty():
            raise ValueError(f"the source of a merge has several rows of one {', '.join(keys)}")
        values = self._values(source, parts)
        if not values:
            return m["version"]
        old = self._rows(m) if not parts else self._rows(m).filter(self._among(parts, values))
        same = lambda a, b: reduce(and_, [a[k].eqNullSafe(b[f"__{k}"]) for k in keys])
        named = lambda df: df.select(*[F.col(k).alias(f"__{k}") for k in keys])
        if insert and update:
            added = source
        else:
            known = named(old)
            added = source.join(known, same(source, known), "left_anti" if insert else "left_semi")
        if update:
            gone = named(source)
            added = old.join(gone, same(old, gone), "left_anti").unionByName(added)
        write, rows = self._write(added, m, rules or {})
        if not rows and not update and not batch:
            self._fs.delete(self._at(f"data/{write}"), True)
            return m["version"]
        return self._publish(m, write, add=not update, batch=batch)

    def replace_partitions(self, df: DataFrame, rules: dict[tuple[str, str], Column] | None = None) -> int:
        """Publish the table with df in place of all rows of the partitions that df has rows of."""
        m = self.manifest()
        return self._publish(m, self._write(df, m, rules or {})[0], add=False)

    def replace_from(self, column: str, start: object, fresh: DataFrame, rules: dict[tuple[str, str], Column] | None = None) -> int:
        """Publish fresh in place of all rows whose `column` is `start` or more. Partitions that hold such rows, or get
        some, are written again with the rows of theirs that are below; the files of all others stay."""
        m = self.manifest()
        whole, late = self._rows(m), F.col(column) >= F.lit(start)
        touched = {self._name(m, v) for df in (whole.filter(late), fresh) for v in self._values(df, m["partition_by"])}
        below = self._rows(m, touched & set(m["parts"])).filter(~late | F.col(column).isNull())
        write, _ = self._write(below.unionByName(fresh.select(*below.columns)), m, rules or {})
        rest = {p: w for p, w in m["parts"].items() if p not in touched}
        return self._publish(m | {"parts": rest}, write, add=False)

    def overwrite(self, df: DataFrame, rules: dict[tuple[str, str], Column] | None = None) -> int:
        """Publish df as the whole table."""
        m = self.manifest()
        return self._publish(m | {"parts": {}}, self._write(df, m, rules or {})[0], add=False)

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete folders that none of the last `keep` versions names, and older manifests; the names of what went. Only
        for times without writers, as what a running write has put down is not named yet."""
        known = self.versions()
        for v in known[:-keep]:
            self._fs.delete(self._at(f"versions/{v:010d}.json"), False)
        named = {w for v in known[-keep:] for writes in self.manifest(v)["parts"].values() for w in writes}
        there = [s.getPath() for s in self._fs.globStatus(self._at(f"data/{WRITE}=*")) or []]
        gone = [p for p in there if p.getName() not in named]
        for p in gone:
            self._fs.delete(p, True)
        return sorted(p.getName() for p in gone)

    # --- inner parts ---

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    @staticmethod
    def _values(source: DataFrame, parts: list[str]) -> list:
        """The partitions of source: one row each on the driver, as a manifest has them too. Without partition columns one
        empty row if source has rows."""
        return source.select(*parts).distinct().collect() if parts else source.limit(1).select().collect()

    @staticmethod
    def _among(parts: list[str], values: list) -> Column:
        if len(parts) == 1 and all(v[0] is not None for v in values):
            return F.col(parts[0]).isin([v[0] for v in values])
        return reduce(or_, [reduce(and_, [F.col(p).eqNullSafe(F.lit(v[p])) for p in parts]) for v in values])

    def _write(self, df: DataFrame, m: dict, rules: dict[tuple[str, str], Column]) -> tuple[str, int]:
        """Write df to a new folder: its name, and its rows. The rules' failures are counted over what was written, whose
        columns they name alone are read; one that fails raises RulesFailed."""
        schema, parts = T.StructType.fromJson(m["schema"]), m["partition_by"]
        if {f.name: f.dataType for f in df.schema} != {f.name: f.dataType for f in schema}:
            raise ValueError(f"columns {df.schema.simpleString()} are not those of {schema.simpleString()}")
        name = f"{WRITE}={uuid.uuid4().hex}"
        rows = df.select(*schema.names)
        rows = rows.hint("rebalance", *parts) if parts else rows  # large partitions are split over tasks
        writer = rows.write.mode("errorifexists")
        (writer.partitionBy(*parts) if parts else writer).parquet(f"{self.path}/data/{name}")
        done = self.spark.read.schema(schema).parquet(f"{self.path}/data/{name}")
        try:
            require(done, rules)
        except RulesFailed:
            self._fs.delete(self._at(f"data/{name}"), True)
            raise
        return name, done.count()  # from the files' ends

    def _name(self, m: dict, value) -> str:
        """A partition's folders as Spark names them."""
        escape = self._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        text = lambda v: "__HIVE_DEFAULT_PARTITION__" if v is None or v == "" else escape(str(v).lower() if isinstance(v, bool) else str(v))
        return "/".join(f"{escape(p)}={text(value[p])}" for p in m["partition_by"])

    def _publish(self, m: dict, write: str, add: bool, batch: tuple[str, int] | None = None) -> int:
        """The next version after m, in which the partitions of the folder `write` are that folder (add: and what they
        were); raises Conflict if there is one already."""
        depth = len(m["partition_by"])
        if depth:
            found = [s.getPath() for s in self._fs.globStatus(self._at(f"data/{write}{'/*=*' * depth}")) or []]
            new = ["/".join(p.toString().rsplit("/", depth)[1:]) for p in found]
        else:
            new = [""]
        parts = m["parts"] | {p: [*(m["parts"].get(p, []) if add else []), write] for p in new}
        number = m["version"] + 1
        out = m | {"version": number, "parts": parts, "batches": m["batches"] | ({batch[0]: batch[1]} if batch else {})}
        self._swap(json.dumps(out, sort_keys=True), f"versions/{number:010d}.json")
        return number

    def _swap(self, text: str, goal: str) -> None:
        """The one step that publishes: a written file gets its name, unless that is taken."""
        draft, goal = self._at(f"versions/.{uuid.uuid4().hex}"), self._at(goal)
        stream = self._fs.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        with _LOCK:
            taken = self._fs.exists(goal)
            if not taken and self._fs.rename(draft, goal):
                return
        self._fs.delete(draft, False)
        raise Conflict(f"{goal.getName()} of {self.path} is there: another writer was first")
