"""Loads of several tables that take effect at once.

Rows of a load are written to folders of their own, which nobody reads yet.
Then one small file is renamed into the log: it says, for each table and day
the load replaces, which files hold the day from now on. Readers ask the log
first, so a load is seen as a whole or not at all, whatever it replaces, and
one that stops before the rename has changed nothing. The log is also the
ledger of what was loaded when.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions.dates import Day
from meterlake.schemas import TABLES
from meterlake.sinks.clustering import laid_out

LOG = "version bigint, load string, table string, day date, paths array<string>, rows bigint"
REJECTED, STATUS, SEEN = "_rejected", "_status", "_seen"
# Blocks of the Bloom filters that ``history`` keeps beside a table, one set for each load and day.
SEEN_DDL = "day date, load string, parts bigint, part bigint, bits binary"
# What a load did for a day of a table.
STATUS_DDL = "date date, rows bigint, rejected bigint, total_cost double, status string, reason string, alert boolean, run string"


class Conflict(Exception):
    """Another load took the version; nothing of this one is visible."""


@dataclass(frozen=True)
class Change:
    """New rows of a table, and the days they replace: those with rows, the ``span`` from first to last, and ``days``.

    With ``append`` they replace nothing: what a day holds stays beside them.
    Files are sorted by the declared cluster columns one after the other, or
    by the columns in ``by`` interleaved (see ``clustering``).
    """

    rows: DataFrame
    span: tuple[dt.date, dt.date] | None = None
    days: list[dt.date] = field(default_factory=list)
    append: bool = False
    by: tuple[str, ...] = ()


def schema_of(table: str) -> tuple[T.StructType, str, tuple[str, ...]]:
    """Columns, day column and cluster columns of a table, or of what is kept beside it: rejected rows (``_rejected``), load status
    (``_status``) and filters of its keys (``_seen``)."""
    if table.endswith(SEEN):
        return T.StructType.fromDDL(SEEN_DDL), "day", ()
    if table.endswith(STATUS):
        return T.StructType.fromDDL(STATUS_DDL), "date", ()
    spec = TABLES[table.removesuffix(REJECTED)]
    if spec.partition is None:
        raise ValueError(f"{table} has no days")
    if table.endswith(REJECTED):
        return T.StructType([*spec.schema.fields, T.StructField("errors", T.ArrayType(T.StringType())), T.StructField("load_day", T.DateType())]), "load_day", ()
    return spec.schema, spec.partition, spec.cluster


class Loads:
    """Tables under one folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()

    # --- files ---

    def _path(self, *parts: str):
        return self._hadoop.Path("/".join([self.root, *parts]))

    def _exists(self, *parts: str) -> bool:
        path = self._path(*parts)
        return path.getFileSystem(self._conf).exists(path)

    def _publish(self, name: str, text: str) -> bool:
        """Write a file whole and rename it into the log; False if there is one of that name."""
        draft, final = self._path("log", f"_{uuid.uuid4().hex}"), self._path("log", name)
        out = draft.getFileSystem(self._conf).create(draft, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        context = self._hadoop.FileContext.getFileContext(final.toUri(), self._conf)
        never = self.spark.sparkContext._gateway.new_array(self._hadoop.Options.Rename, 0)
        try:
            context.rename(draft, final, never)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in str(e.java_exception.getClass()):
                context.delete(draft, False)
                return False
            raise
        return True

    # --- the log ---

    def log(self) -> DataFrame:
        """Every entry: version, load, table, day, paths that hold the day from then on (none: it was removed), rows."""
        if not self._exists("log"):
            return self.spark.createDataFrame([], LOG)
        return self.spark.read.schema(LOG).json(f"{self.root}/log")

    def state(self, version: int | None = None) -> DataFrame:
        """The days that are live, now or at an earlier version: the last entry of each table and day."""
        log = self.log() if version is None else self.log().where(F.col("version") <= version)
        last = log.groupBy("table", "day").agg(F.max_by(F.struct("version", "load", "paths", "rows"), "version").alias("e"))
        return last.where(F.size("e.paths") > 0).select("table", "day", "e.*")

    def version(self) -> int:
        return self.log().agg(F.max("version")).first()[0] or 0

    def days(self, table: str, start: Day | None = None, end: Day | None = None, version: int | None = None) -> dict[dt.date, list[str]]:
        """Live days and the paths that hold them: one entry per calendar day."""
        rows = self.state(version).where(F.col("table") == table)
        if start is not None:
            rows = rows.where(F.col("day") >= F.lit(str(start)).cast("date"))
        if end is not None:
            rows = rows.where(F.col("day") <= F.lit(str(end)).cast("date"))
        return {r.day: r.paths for r in rows.collect()}

    # --- reading ---

    def _files(self, table: str, paths: list[str]) -> DataFrame:
        schema, _, _ = schema_of(table)
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/data/{table}")
        return reader.parquet(*[f"{self.root}/{p}" for p in sorted(paths)]).select(*schema.names)

    def read(self, table: str, start: Day | None = None, end: Day | None = None, version: int | None = None) -> DataFrame:
        """The live rows; days outside [start, end] are not even listed. Columns that files lack are NULL."""
        found = self.days(table, start, end, version)
        return self._files(table, [p for paths in found.values() for p in paths])

    def read_days(self, table: str, days: list[dt.date], version: int | None = None) -> DataFrame:
        """The live rows of the listed days; no other day's files are looked at."""
        wanted = set(days)
        return self._files(table, [p for d, paths in self.days(table, version=version).items() if d in wanted for p in paths])

    # --- writing ---

    def _written(self, table: str, rows: DataFrame, load: str, by: tuple[str, ...] = ()) -> dict[dt.date, tuple[list[str], int]]:
        """Write rows by day where nobody reads yet; the folder and the number of rows of each day."""
        schema, day, cluster = schema_of(table)
        if "ingestion_timestamp" in schema.names and "ingestion_timestamp" not in rows.columns:
            rows = rows.withColumn("ingestion_timestamp", F.current_timestamp())
        extra = [c for c in rows.columns if c not in schema.names]
        if extra:
            raise ValueError(f"{table} has no column {', '.join(extra)}")
        rows = rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
        place = f"data/{table}/load={load}"
        # What an attempt that stopped has left under the same name goes.
        ordered = laid_out(rows, day, list(by)) if by else rows.hint("rebalance", day).sortWithinPartitions(day, *cluster)
        out = ordered.write.mode("overwrite").option("partitionOverwriteMode", "static")
        out.partitionBy(day).parquet(f"{self.root}/{place}")
        counts = self.spark.read.schema(schema).parquet(f"{self.root}/{place}").groupBy(day).count().collect()  # one row per calendar day
        if any(r[0] is None for r in counts):
            raise ValueError(f"{table}: rows without {day}; nothing was loaded")
        return {r[0]: ([f"{place}/{day}={r[0]}"], r[1]) for r in counts}

    def _commit(self, load: str, changes: Callable[[], dict[str, dict[dt.date, tuple[list[str], int]]]], tries: int = 5, after: int | None = None) -> int:
        for _ in range(tries if after is None else 1):
            version = (self.version() if after is None else after) + 1
            entries = [
                json.dumps({"version": version, "load": load, "table": table, "day": str(day), "paths": paths, "rows": n})
                for table, days in changes().items() for day, (paths, n) in sorted(days.items())
            ]
            if not entries:
                return version - 1
            if self._publish(f"{version:012d}.json", "\n".join(entries) + "\n"):
                return version
        raise Conflict(load)

    def loaded(self, load: str) -> int | None:
        """The version a load of this name made, if it is in the log."""
        return self.log().where(F.col("load") == load).agg(F.max("version")).first()[0]

    def commit(self, changes: dict[str, Change], load: str | None = None, after: int | None = None) -> int:
        """Replace days of several tables at once; returns the version that shows them.

        A load whose name is in the log already changes nothing: repeating it
        after a success is as safe as after a stop. Rows without a day refuse
        the load. ``after`` names the version that the rows were derived from:
        if there is a later one, the load is refused (``Conflict``).
        """
        load = load or uuid.uuid4().hex
        known = self.loaded(load)
        if known is not None:
            return known
        new = {table: self._written(table, change.rows, load, change.by) for table, change in changes.items()}

        def entries() -> dict[str, dict[dt.date, tuple[list[str], int]]]:
            out = {}
            for table, change in changes.items():
                if change.append:
                    held = {r.day: r for r in self.state().where(F.col("table") == table).collect()}  # one row per calendar day
                    out[table] = {d: (held[d].paths + paths, held[d].rows + n) if d in held else (paths, n) for d, (paths, n) in new[table].items()}
                    continue
                live = self.days(table)
                gone = [d for d in live if d in change.days or change.span and change.span[0] <= d <= change.span[1]]
                out[table] = {d: ([], 0) for d in gone} | new[table]
            return out

        return self._commit(load, entries, after=after)

    def replace_range(self, table: str, rows: DataFrame, load: str | None = None) -> tuple[dt.date, dt.date] | None:
        """Replace every day from the first to the last day of ``rows``, those without rows too. Empty input changes nothing."""
        _, day, _ = schema_of(table)
        span = rows.agg(F.min(F.col(day).cast("date")), F.max(F.col(day).cast("date"))).first()
        if span[0] is None:
            return None
        self.commit({table: Change(rows, (span[0], span[1]))}, load)
        return span[0], span[1]

    def recluster(self, table: str, by: list[str] | None = None, start: Day | None = None, end: Day | None = None, load: str | None = None) -> int:
        """Rewrite the live days in [start, end] so that filters on any of ``by`` skip files and row groups; the rows stay the same.

        ``by`` are the declared cluster columns unless named. Small files that
        appends and updates left merge on the way. A load that commits
        meanwhile wins: this one is refused (``Conflict``) and can be repeated.
        """
        _, day, cluster = schema_of(table)
        by, base = tuple(by or [c for c in cluster if c != day]), self.version()
        if not by:
            raise ValueError(f"{table} declares no cluster columns; name some")
        days = self.days(table, start, end, base)
        if not days:
            return base
        rows = self._files(table, [p for paths in days.values() for p in paths])
        return self.commit({table: Change(rows, days=list(days), by=by)}, load, after=base)

    def update(self, table: str, keys: DataFrame, on: list[str], changed: Callable[[DataFrame], DataFrame], load: str | None = None) -> int:
        """Rewrite the files that hold a row with one of ``keys``; all other files stay as they are.

        ``on`` names the key columns, the day among them; ``changed`` gets the
        rows of those files and returns what takes their place, of the same
        days. Files are found by a scan of the key columns of the days in
        ``keys``. Keys without a row change nothing.
        """
        schema, day, _ = schema_of(table)
        wanted = {r[0] for r in keys.select(F.col(day).cast("date")).distinct().collect()}  # at most one per calendar day
        live = {d: paths for d, paths in self.days(table).items() if d in wanted}
        if not live:
            return self.version()
        load, named = load or uuid.uuid4().hex, [p for paths in live.values() for p in paths]
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/data/{table}")
        stored = reader.parquet(*[f"{self.root}/{p}" for p in named])
        hit = stored.select(*on, F.col("_metadata.file_path").alias("_file")).join(keys.select(*on).distinct(), on, "left_semi")
        touched = {self._relative(r[0]) for r in hit.select("_file").distinct().collect()}  # files of the days in question
        if not touched:
            return self.version()
        files = {d: [self._relative(f) for f in reader.parquet(*[f"{self.root}/{p}" for p in paths]).inputFiles()] for d, paths in live.items()}
        new = self._written(table, changed(self._files(table, sorted(touched))), load)
        out = {}
        for d, names in files.items():
            if touched & set(names):
                paths, n = new.get(d, ([], 0))
                kept = [f for f in names if f not in touched]
                out[d] = kept + paths, n + (self._files(table, kept).count() if kept else 0)
        return self._commit(load, lambda: {table: out}, tries=1)

    def _relative(self, file: str) -> str:
        """A file's place below the root, from whatever form of URI Spark gives."""
        marker = "/data/"
        return "data/" + self._hadoop.Path(self.spark._jvm.java.net.URI(file)).toUri().getPath().rsplit(marker, 1)[1]

    def vacuum(self, keep: int = 1) -> int:
        """Delete folders of committed loads that none of the last ``keep`` versions shows; returns how many went."""
        last = self.version()
        entries = self.log().select("version", "table", "day", F.explode("paths").alias("path")).collect()  # table days
        live = set()
        for v in range(max(1, last - keep + 1), last + 1):
            live |= {p for r in self.state(v).select("paths").collect() for p in r.paths}
        used = {p.rsplit("/", 1)[0] if p.endswith(".parquet") else p for p in live}
        dead = {r.path for r in entries if not r.path.endswith(".parquet")} - used
        for path in map(self._path, sorted(dead)):
            path.getFileSystem(self._conf).delete(path, True)
        return len(dead)
