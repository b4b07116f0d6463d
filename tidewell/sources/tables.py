"""Parquet tables under one shared root: versions, partition replacement, upsert and audit appends.

Each write goes to a folder of its own below the table. A version lists the folders (per partition)
that make up the table; the file ``_current`` names the newest version and is replaced by one rename.
A write that fails leaves the table as it was, and a frame read before a write keeps its rows, so a
table may be replaced by a frame that reads it. One writer per table at a time; a second one that
commits in between is refused. ``vacuum`` deletes what no kept version needs.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators import mutation
from tidewell.session import delete_path, hadoop_path, replace_file, read_text, staged

WRITE = "_write"
# Fixed value: the folder name that Spark gives a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class WriteConflict(RuntimeError):
    """A write-once batch exists with other content."""


class ConcurrentWrite(RuntimeError):
    """Another writer committed to the table since this one began."""


@dataclass(frozen=True)
class Version:
    """What a table consists of: its columns, its layout, and per write folder the partitions that count.

    ``parts`` maps a write to partition paths ("month=3"; "" where the table is not partitioned);
    ``whole`` names the writes of which nothing has been replaced. ``marks`` holds the newest batch
    number per source that appends in numbered batches.
    """

    number: int
    name: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    parts: dict[str, tuple[str, ...]] = field(default_factory=dict)
    whole: frozenset[str] = frozenset()
    marks: dict[str, int] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(
            {
                "number": self.number, "schema": self.schema.jsonValue(), "partition_by": self.partition_by,
                "parts": self.parts, "whole": sorted(self.whole), "marks": self.marks,
            }
        )

    @staticmethod
    def from_json(name: str, text: str) -> Version:
        d = json.loads(text)
        parts = {w: tuple(p) for w, p in d["parts"].items()}
        return Version(d["number"], name, T.StructType.fromJson(d["schema"]), tuple(d["partition_by"]), parts, frozenset(d["whole"]), d["marks"])

    def with_write(self, write: str, parts: Iterable[str], schema: T.StructType) -> Version:
        grown = replace(self, schema=_united(self.schema, schema))
        if not (parts := tuple(parts)):
            return grown
        return replace(grown, parts=self.parts | {write: parts}, whole=self.whole | {write})

    def without(self, folders: Iterable[str]) -> Version:
        """The version without the partitions of which a folder ("month=3") is given."""
        gone = set(folders)
        return self._keeping(lambda path: not gone.intersection(path.split("/")))

    def only(self, paths: Iterable[str]) -> Version:
        """The version reduced to the given partition paths."""
        return self._keeping(set(paths).__contains__)

    def _keeping(self, keep: Callable[[str], bool]) -> Version:
        kept = {w: tuple(filter(keep, ps)) for w, ps in self.parts.items()}
        kept = {w: ps for w, ps in kept.items() if ps}
        return replace(self, parts=kept, whole=frozenset(w for w in self.whole & kept.keys() if kept[w] == self.parts[w]))


@dataclass(frozen=True)
class WriteResult:
    status: str
    rows: int | None = None


@dataclass(frozen=True)
class TableStore:
    """Named parquet tables below ``root``, a folder every executor can reach."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def exists(self, name: str) -> bool:
        """True when the table has a version, or is a plain parquet folder; starts no job."""
        if self.version(name):
            return True
        target, fs = hadoop_path(self.spark, self.path(name))
        return fs.exists(target) and not any(c.startswith(f"{WRITE}=") for c in self._children(self.path(name)))

    def version(self, name: str) -> Version | None:
        """The newest version, read from ``_current``; None where there is none yet."""
        current = read_text(self.spark, f"{self.path(name)}/_current")
        return current and Version.from_json(current, read_text(self.spark, f"{self.path(name)}/_versions/{current}"))

    def read(self, name: str, schema: T.StructType | None = None, merge: bool = False) -> DataFrame:
        """The rows of the newest version; columns that were added later are null in older rows.

        A plain parquet folder without versions is scanned as it is, with ``merge`` over the
        schemas of all its files.
        """
        if version := self.version(name):
            return self.scan(name, version)
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.option("mergeSchema", str(merge).lower()).parquet(self.path(name))

    def read_partitions(self, name: str, column: str, values: Iterable) -> DataFrame:
        """The partitions with these values of a partition column. No other folder is listed or read."""
        version = self._partitioned(name, column)
        wanted = {self._folder(column, v) for v in values}
        paths = [p for ps in version.parts.values() for p in ps if wanted.intersection(p.split("/"))]
        return self.scan(name, version.only(paths))

    def scan(self, name: str, version: Version) -> DataFrame:
        """The rows of a version, whatever is written afterwards."""
        root = self.path(name)
        paths = []
        for write, parts in version.parts.items():
            folder = f"{root}/{WRITE}={write}"
            paths += [folder] if write in version.whole else [f"{folder}/{p}" for p in parts]
        if not paths:
            return self.spark.createDataFrame([], version.schema)
        fields = T.StructType([*version.schema.fields, T.StructField(WRITE, T.StringType())])
        rows = self.spark.read.schema(fields).option("basePath", root).parquet(*paths)
        return rows.select(*[f"`{c}`" for c in version.schema.names])

    def overwrite(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> WriteResult:
        """Replace rows, columns and layout in one step. ``df`` may read from this table."""
        before = self.version(name)
        write, parts = self._write(name, df, partition_by)
        fresh = Version(0, "", T.StructType([]), tuple(partition_by), marks=before.marks if before else {})
        return WriteResult("overwritten", self._commit(name, before, fresh.with_write(write, parts, df.schema), write))

    def append(
        self, name: str, df: DataFrame, partition_by: Sequence[str] = (), batch: tuple[str, int] | None = None
    ) -> WriteResult:
        """Add rows in the table's own layout; ``partition_by`` counts when it is new. New columns are allowed.

        With ``batch`` (source, number) a batch of which the table already has that number or a later
        one is skipped, so a source that repeats its last batch after a failure adds nothing.
        """
        before = self.version(name)
        if before and partition_by and tuple(partition_by) != before.partition_by:
            raise ValueError(f"{name} is partitioned by {before.partition_by}, not {tuple(partition_by)}")
        version = before or Version(0, "", T.StructType([]), tuple(partition_by))
        if batch and version.marks.get(batch[0], -1) >= batch[1]:
            return WriteResult("skipped", 0)
        write, parts = self._write(name, df, version.partition_by)
        if batch:
            version = replace(version, marks=version.marks | {batch[0]: batch[1]})
        return WriteResult("appended", self._commit(name, before, version.with_write(write, parts, df.schema), write))

    def create_if_absent(self, name: str, like: DataFrame, partition_by: Sequence[str] = ()) -> WriteResult:
        """An empty table with the columns of ``like``, unless the table exists; starts no job."""
        if self.exists(name):
            return WriteResult("exists")
        self._commit(name, None, Version(0, "", like.schema, tuple(partition_by)))
        return WriteResult("created", 0)

    def replace_partition(self, name: str, df: DataFrame, column: str, value) -> WriteResult:
        """Replace exactly the partition ``column = value``; an empty ``df`` empties it.

        ``df`` may read the same table.
        """
        inside = F.col(column) == F.lit(value).cast(df.schema[column].dataType)
        stray = F.raise_error(F.lit(f"row outside partition {column}={value}")).cast("boolean")
        return self.replace_partitions(name, df.where(F.when(inside, F.lit(True)).otherwise(stray)), column, [value])

    def replace_partitions(
        self, name: str, df: DataFrame, column: str, values: Iterable = (), marks: dict[str, int] | None = None
    ) -> WriteResult:
        """Replace every partition that ``df`` has rows for, and those of ``values`` even if it has none.

        The other partitions stay as they are. ``df`` may read the same table. ``marks`` (batch numbers
        by source, up to which the table now covers) are stored in the same step.
        """
        before = self._partitioned(name, column) if self.version(name) else None
        version = before or Version(0, "", T.StructType([]), (column,))
        write, parts = self._write(name, df, version.partition_by)
        gone = {f for p in parts for f in p.split("/") if f.startswith(f"{column}=")}
        kept = version.without(gone | {self._folder(column, v) for v in values})
        kept = replace(kept, marks=kept.marks | (marks or {}))
        return WriteResult("replaced", self._commit(name, before, kept.with_write(write, parts, df.schema), write))

    def upsert(
        self,
        name: str,
        source: DataFrame,
        keys: Sequence[str],
        partition: str,
        on_new_columns: str = "merge",
    ) -> WriteResult:
        """MERGE on ``keys``: matched rows are replaced, others inserted.

        ``partition`` is one of the keys. Only partitions that the source touches
        are read and rewritten. Source and merged rows are staged, so the source is
        evaluated once and the target is not overwritten while it is read. When the
        source brings new columns, old rows are kept and hold null there; only with
        ``on_new_columns="recreate"`` the table is made anew from the source alone.
        """
        if on_new_columns not in ("recreate", "merge"):
            raise ValueError("on_new_columns must be 'recreate' or 'merge'")
        with staged(source, "upsert") as rows:
            mutation.require_unique(rows, keys)
            if not self.exists(name):
                return WriteResult("created", self.overwrite(name, rows, [partition]).rows)
            version = self._partitioned(name, partition)
            if set(rows.columns) - set(version.schema.names) and on_new_columns == "recreate":
                return WriteResult("recreated", self.overwrite(name, rows, [partition]).rows)
            touched = [r[0] for r in rows.select(partition).distinct().collect()]  # one value per partition
            target = self.read_partitions(name, partition, touched)
            self.replace_partitions(name, mutation.upsert(target, rows, keys), partition, touched)
            return WriteResult("merged", rows.count())

    def insert_new(self, name: str, source: DataFrame, keys: Sequence[str], partition_by: Sequence[str] = ()) -> WriteResult:
        """Insert-only MERGE: rows whose key is absent are appended in the table's layout, the rest ignored.

        Where the partition columns are part of the key, only the partitions that the source touches
        are read. A new table is partitioned by ``partition_by``.
        """
        self.create_if_absent(name, source, partition_by)
        version = self.version(name)
        with staged(source, "insert") as rows:
            if version.partition_by and set(version.partition_by) <= set(keys):
                texts = rows.select(*[F.col(c).cast("string") for c in version.partition_by]).distinct()
                paths = ["/".join(self._folder(c, r[c]) for c in version.partition_by) for r in texts.collect()]
                version = version.only(paths)
            return self.append(name, mutation.rows_to_insert(self.scan(name, version), rows, keys))

    def seed(self, name: str, df: DataFrame, source_type: str) -> WriteResult:
        """Load a source once: created, appended, or skipped when its rows are there."""
        if not self.exists(name):
            return WriteResult("created", self.overwrite(name, df).rows)
        current = self.read(name)
        if "_source_type" in current.columns:
            current = current.where(F.col("_source_type") == source_type)
        existing = current.count()
        return WriteResult("skipped", existing) if existing else self.append(name, df)

    def publish_once(self, name: str, batch: DataFrame) -> WriteResult:
        """Write-once batch: created, unchanged when identical, else ``WriteConflict``."""
        if not self.exists(name):
            return WriteResult("created", self.overwrite(name, batch).rows)
        current = self.read(name)
        if set(current.columns) != set(batch.columns):
            raise WriteConflict(f"{name} exists with other columns")
        if not mutation.content_difference(current, batch).isEmpty():
            raise WriteConflict(f"{name} exists with other rows")
        return WriteResult("unchanged")

    def view(self, view_name: str, df: DataFrame) -> DataFrame:
        df.createOrReplaceTempView(view_name)
        return self.spark.table(view_name)

    def vacuum(self, name: str, keep: int = 2) -> int:
        """Delete the write folders and versions that the newest ``keep`` versions do not need; how many folders went.

        Frames read from older versions can no longer be evaluated.
        """
        root = self.path(name)
        names = sorted(self._children(f"{root}/_versions"))
        current = self.version(name)
        # A version above the current one, or under a name not yet final, was never made the newest.
        made = [n for n in names if n.count(".") == 0 and int(n.split("-")[0]) <= current.number]
        kept = {*made[-keep:], current.name} if keep > 0 else {current.name}
        needed = {w for n in kept for w in Version.from_json(n, read_text(self.spark, f"{root}/_versions/{n}")).parts}
        unused = [c for c in self._children(root) if c.startswith(f"{WRITE}=") and c.split("=", 1)[1] not in needed]
        for path in [*unused, *[f"_versions/{n}" for n in names if n not in kept]]:
            delete_path(self.spark, f"{root}/{path}")
        return len(unused)

    def _partitioned(self, name: str, column: str) -> Version:
        version = self.version(name)
        if version is None or column not in version.partition_by:
            raise ValueError(f"{name} is not a table partitioned by {column}")
        return version

    def _folder(self, column: str, value) -> str:
        """The folder name of a partition value, as Spark writes it."""
        escape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        text = "" if value is None else str(value)
        return f"{escape(column)}={escape(text) if text else NULL_PARTITION}"

    def _children(self, path: str) -> list[str]:
        target, fs = hadoop_path(self.spark, path)
        return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []

    def _write(self, name: str, df: DataFrame, partition_by: Sequence[str]) -> tuple[str, list[str]]:
        """Write rows to a folder of their own; its id and the partition paths it has."""
        write = f"w{uuid.uuid4().hex}"
        folder = f"{self.path(name)}/{WRITE}={write}"
        _writer(df, partition_by).mode("errorifexists").parquet(folder)
        parts = [""]
        for _ in partition_by:
            parts = [f"{p}/{c}".lstrip("/") for p in parts for c in self._children(f"{folder}/{p}") if "=" in c]
        return write, parts

    def _commit(self, name: str, before: Version | None, after: Version, write: str | None = None) -> int:
        """Make ``after`` the newest version if ``before`` still is; the rows of the write, by its footers."""
        number = (before.number if before else 0) + 1
        after = replace(after, number=number, name=f"{number:012d}-{uuid.uuid4().hex[:12]}")
        root = self.path(name)
        replace_file(self.spark, f"{root}/_versions/{after.name}", after.to_json())
        if read_text(self.spark, f"{root}/_current") != (before.name if before else None):
            raise ConcurrentWrite(f"another writer changed {name}")
        replace_file(self.spark, f"{root}/_current", after.name)
        return self.scan(name, replace(after, parts={write: after.parts[write]}, whole=frozenset([write]))).count() if after.parts.get(write) else 0


def _united(schema: T.StructType, other: T.StructType) -> T.StructType:
    """The columns of both; all may be null, since a write may lack them."""
    types = {f.name: f.dataType for f in schema}
    for f in other:
        if types.setdefault(f.name, f.dataType).simpleString() != f.dataType.simpleString():
            raise TypeError(f"column {f.name} is {types[f.name].simpleString()}, not {f.dataType.simpleString()}")
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


def land_json_by_day(df: DataFrame, path: str, date_column: str) -> None:
    """Append JSON lines below ``year=/month=/day=`` folders of the event date."""
    day = F.col(date_column).cast("date")
    parts = {"year": F.date_format(day, "yyyy"), "month": F.date_format(day, "MM"), "day": F.date_format(day, "dd")}
    _writer(df.withColumns(parts), list(parts)).mode("append").json(path)


def _writer(df: DataFrame, partition_by: Sequence[str]):
    """A writer that brings the rows of a folder together, so few tasks write to each.

    Adaptive execution splits a folder that is too large for one task.
    """
    if not partition_by:
        return df.write
    return df.hint("rebalance", *partition_by).write.partitionBy(*partition_by)
