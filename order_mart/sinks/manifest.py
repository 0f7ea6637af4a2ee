"""Versioned publishing of several tables behind one pointer.

A store is a folder.  Every table's data lies in segments, folders that are
written once and never changed; a segment holds one part of its table (a date,
a range of keys, or all of it).  A version is the list of the segments that
make up every table, appended to the store's manifest as one file.  The
highest version in the manifest is the pointer: it moves when that file
becomes visible, for all tables at once, and a run that fails before leaves
the old version in place.  A version that changes a few parts lists the other
parts' old segments again, so nothing is copied.

The manifest's rows are bounded by the number of parts, which is checked.
They also carry the id of the batch that made the version, committed with the
data: a batch that is replayed finds its id and changes nothing.

One writer at a time is expected per store; a commit that does not build on
the current version is refused.
"""

from __future__ import annotations

import contextlib
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from .ddl import create_database, ddl_columns

MANIFEST = "manifest"
MANIFEST_SCHEMA = "version bigint, batch string, table_name string, part string, segment string, path string"
#: Table property with the declared NOT NULL columns, which Parquet tables do not keep.
NOT_NULL = "order_mart.not_null"
#: Part name of a table that is not split.
WHOLE = "all"
#: Parts that a table may have; beyond it, choose wider parts.
MAX_PARTS = 10_000


#: Setting: files that a task of a partitioned write keeps open.
OPEN_PARTS = "spark.sql.maxConcurrentOutputFileWriters"


@contextlib.contextmanager
def open_parts(spark: SparkSession, files: int = 8) -> Iterator[None]:
    """Let tasks that write parts keep a file open for each of their parts (the
    rows of further ones are sorted by part), so that rows are sorted by their
    order key alone, a number, and not by the parts' names first."""
    old = spark.conf.get(OPEN_PARTS)
    spark.conf.set(OPEN_PARTS, max(int(old), files))
    try:
        yield
    finally:
        spark.conf.set(OPEN_PARTS, old)


class StoreError(ValueError):
    """A publish that does not fit its target; nothing was changed."""


def check_fits(name: str, found: T.StructType, declared: T.StructType) -> None:
    """Names and types of ``found`` are those of ``declared`` (any order)."""
    want = {f.name: f.dataType for f in declared.fields}
    have = {f.name: f.dataType for f in found.fields}
    if want != have:
        wrong = sorted(c for c in want.keys() | have.keys() if want.get(c) != have.get(c))
        raise StoreError(f"{name}: columns {wrong} differ from the published schema; publish into another store or database")


@dataclass(frozen=True)
class Segment:
    table: str
    part: str
    name: str
    path: str


@dataclass
class Snapshot:
    """All tables at one version; later commits do not change what it reads."""

    store: VersionedStore
    version: int
    segments: list[Segment]
    batches: set[str] = field(default_factory=set)

    def parts(self, table: str) -> dict[str, Segment]:
        return {s.part: s for s in self.segments if s.table == table}

    def table(self, table: str, parts: list[str] | None = None) -> DataFrame:
        """A table, or those of its ``parts`` that exist; no file of another
        part is listed or read."""
        own = self.parts(table)
        paths = [s.path for p, s in own.items() if parts is None or p in parts]
        spark, schema = self.store.spark, self.store.tables[table]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], _nullable(schema))


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


@dataclass
class VersionedStore:
    """A store at ``location`` for ``tables`` (name -> declared schema)."""

    spark: SparkSession
    location: str
    tables: dict[str, T.StructType]
    database: str | None = None

    def _manifest(self) -> DataFrame | None:
        """The manifest's files as they are now, or None before the first commit."""
        path = os.path.join(self.location, MANIFEST)
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return self.spark.read.schema(MANIFEST_SCHEMA).parquet(path) if files.exists(folder) else None

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The newest version, or a given one.  One read of the manifest."""
        rows = self._manifest()
        found = [] if rows is None else rows.filter(F.col("version") <= version if version is not None else F.lit(True)).collect()
        newest = max((r.version for r in found), default=0)
        if version not in (None, newest):
            raise StoreError(f"no version {version} in {self.location}")
        return Snapshot(self, newest, [Segment(r.table_name, r.part, r.segment, r.path) for r in found if r.version == newest and r.segment],
                        {r.batch for r in found if r.batch})

    def stage(self, table: str, df: DataFrame, part: str | None = None, sort: tuple[str, ...] = ()) -> dict[str, str]:
        """Write ``df`` into new segments, one for each value of the column
        ``part`` (rows without one: ``__HIVE_DEFAULT_PARTITION__``); (part ->
        path).  The rows of a part are split over tasks where they are many.  ``sort`` orders the rows within files, for
        row-group statistics.  Nothing is visible before the commit."""
        columns = [f.name for f in self.tables[table].fields]
        check_fits(table, df.select(*[c for c in df.columns if c != part or part in columns]).schema, self.tables[table])
        folder = os.path.join(self.location, table, f"run={uuid.uuid4().hex}")
        if part is None:
            out = df.select(*columns)
            (out.sortWithinPartitions(*sort) if sort else out).write.parquet(folder)
            return {WHOLE: folder}
        out = df.select(*columns, F.col(part).alias("_part")).hint("rebalance", F.col("_part"))
        # a file stays open for each part under ``open_parts``; else the writer needs the rows of a part together
        order = sort if int(self.spark.conf.get(OPEN_PARTS)) > 0 else ("_part", *sort)
        (out.sortWithinPartitions(*order) if order else out).write.partitionBy("_part").parquet(folder)
        found = self._folders(folder)
        if len(found) > MAX_PARTS:
            raise StoreError(f"{table}: more than {MAX_PARTS} parts; choose wider ones")
        return {unquote(name.removeprefix("_part=")): os.path.join(folder, name) for name in found}

    def _folders(self, path: str) -> list[str]:
        """Names of the part folders in ``path``, by one listing."""
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in files.listStatus(folder) if s.getPath().getName().startswith("_part=")]

    def commit(self, base: Snapshot, batch: str, staged: dict[str, dict[str, str]],
               touched: dict[str, list[str]] | None = None) -> Snapshot:
        """Make ``staged`` (table -> part -> path) the next version.

        A table that ``touched`` names keeps the parts it does not list and
        loses the listed ones that are not staged; any other staged table is
        replaced whole, and tables that are not staged stay.  A batch id that
        was committed before changes nothing.
        """
        now = self.snapshot()
        if batch in now.batches:
            return now
        if now.version != base.version:
            raise StoreError(f"version {now.version} was published since {base.version}; start again from it")
        kept = []
        for s in base.segments:
            replaced = s.table in staged and (s.table not in (touched or {}) or s.part in touched[s.table] or s.part in staged[s.table])
            if not replaced:
                kept.append(s)
        run = uuid.uuid4().hex
        new = [Segment(t, p, f"{run}-{p}", path) for t, own in staged.items() for p, path in own.items()]
        for table in self.tables:
            if sum(s.table == table for s in [*kept, *new]) > MAX_PARTS:
                raise StoreError(f"{table}: more than {MAX_PARTS} parts; choose wider ones")
        if self.database:
            self._register(new)
        version = now.version + 1
        rows = [(version, batch, s.table, s.part, s.name, s.path) for s in [*kept, *new]] or [(version, batch, None, None, None, None)]
        (self.spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1)                # one file: visible at once
         .write.mode("append").parquet(os.path.join(self.location, MANIFEST)))
        if self.database:
            self.spark.catalog.refreshTable(f"{self.database}.{MANIFEST}")
        return Snapshot(self, version, [*kept, *new], now.batches | {batch})

    def unreferenced(self, keep: int) -> list[str]:
        """Segment folders that none of the newest ``keep`` versions holds;
        with a database their partitions are dropped.  Removing the folders is
        the caller's step, once no reader of an older version is left."""
        rows = self._manifest()
        if rows is None:
            return []
        newest = self.snapshot().version
        found = rows.filter(F.col("segment").isNotNull()).groupBy("table_name", "segment", "path").agg(F.max("version").alias("last"))
        gone = found.filter(F.col("last") <= newest - keep).collect()
        if self.database:
            for r in gone:
                self.spark.sql(f"ALTER TABLE {self._data(r.table_name)} DROP IF EXISTS PARTITION (segment = '{r.segment}')")
        return sorted(r.path for r in gone)

    # --- catalog ------------------------------------------------------------
    def _data(self, table: str) -> str:
        return f"{self.database}.{table}__segments"

    def _register(self, segments: list[Segment], at_once: int = 200) -> None:
        for table in dict.fromkeys(s.table for s in segments):
            own = [s for s in segments if s.table == table]
            for i in range(0, len(own), at_once):
                added = " ".join(f"PARTITION (segment = '{s.name}') LOCATION '{s.path}'" for s in own[i: i + at_once])
                self.spark.sql(f"ALTER TABLE {self._data(table)} ADD IF NOT EXISTS {added}")

    def create(self) -> VersionedStore:
        """Database, data tables with the declared columns, the manifest table,
        and a view of each table at the newest version.

        A table or a view of other columns under a view's name is refused
        before anything is made.  The segments behind a view are chosen by the
        manifest and pruned as partitions.  A session keeps its listing of the
        manifest until ``refresh``; a reader of several queries takes a
        ``snapshot``.
        """
        spark, db = self.spark, self.database
        create_database(spark, db)
        for table, schema in self.tables.items():
            self._check_view(table, schema)
        base = self.snapshot()
        path = os.path.join(self.location, MANIFEST)
        if not spark.catalog.tableExists(f"{db}.{MANIFEST}"):
            if base.version == 0:
                spark.createDataFrame([], MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(path)
            spark.sql(f"CREATE TABLE {db}.{MANIFEST} ({MANIFEST_SCHEMA}) USING parquet LOCATION '{path}'")
        for table, schema in self.tables.items():
            if not spark.catalog.tableExists(self._data(table)):
                spark.sql(f"CREATE TABLE {self._data(table)} ({ddl_columns(schema)}, segment STRING) "
                          f"USING parquet PARTITIONED BY (segment) LOCATION '{os.path.join(self.location, table)}' "
                          f"TBLPROPERTIES ('{NOT_NULL}' = '{','.join(f.name for f in schema.fields if not f.nullable)}')")
            if not spark.catalog.tableExists(f"{db}.{table}"):
                columns = ", ".join(f"`{f.name}`" for f in schema.fields)
                spark.sql(f"CREATE VIEW {db}.{table} AS SELECT {columns} FROM {self._data(table)} WHERE segment IN ("
                          f"SELECT segment FROM {db}.{MANIFEST} WHERE table_name = '{table}' "
                          f"AND version = (SELECT max(version) FROM {db}.{MANIFEST}))")
        self._register(base.segments)
        return self

    def _check_view(self, table: str, schema: T.StructType) -> None:
        name = f"{self.database}.{table}"
        if self.spark.catalog.tableExists(name):
            if self.spark.catalog.getTable(name).tableType != "VIEW":
                raise StoreError(f"{name} is a table; a versioned publish needs a view there: drop it or use another database")
            check_fits(name, self.spark.table(name).schema, schema)

    def refresh(self) -> None:
        """Let this session's views follow commits of other sessions."""
        self.spark.catalog.refreshTable(f"{self.database}.{MANIFEST}")
        for table in self.tables:
            self.spark.catalog.refreshTable(self._data(table))


def database_location(spark: SparkSession, database: str) -> str:
    """Folder of a database, which is created if it does not exist."""
    create_database(spark, database)
    return next(r[1] for r in spark.sql(f"DESCRIBE DATABASE {database}").collect() if r[0] == "Location")


def open_store(spark: SparkSession, database: str, tables: dict[str, T.StructType]) -> VersionedStore:
    """The store of a database, below the database's folder, with its views."""
    return VersionedStore(spark, os.path.join(database_location(spark, database), "_versions"), tables, database).create()
