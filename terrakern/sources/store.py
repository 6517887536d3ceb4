"""A versioned pixel store of plain Parquet: data files first, then one commit row that readers follow.

Layout of a store: ``data/commit=<id>/zone=<z>/year=<y>``, ``commits`` (one small file per
commit), ``claims`` (an empty file per commit number, created exclusively) and ``tags``.
A reader takes, for every (zone, year, tile), the rows of the newest commit in its
snapshot that wrote the tile.  Commits are ordered by their numbers: of two writers
who start from one version, the one who claims the next number first wins.
"""

from __future__ import annotations

import datetime
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrakern.sources.files import claimed, names, verified_delete

COMMITS = "commit string, seq long, parent string, at timestamp, mode string, run_id string, zone string, year int, tiles array<string>, newest_day date"
TAGS = "tag string, commit string"


class NonMonotonicDateError(ValueError):
    """A day at or before the newest stored one."""


class DuplicateDateError(NonMonotonicDateError):
    """The newest stored day again."""


class CommitConflictError(RuntimeError):
    """Another writer has committed since the version that this commit started from."""


class StoreExistsError(ValueError):
    """The place already holds committed data."""


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a small table; empty only if it is genuinely absent."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


@dataclass
class PixelStore:
    """A store at ``path`` whose rows have zone, year, tile and the ``schema``'s further columns."""

    spark: SparkSession
    path: str
    schema: str

    def create(self) -> PixelStore:
        """Seed an empty store; refuses a place with commits."""
        if not self.commits().isEmpty():
            raise StoreExistsError(self.path)
        return self

    def commits(self, snapshot: str | None = None) -> DataFrame:
        """The commit log, or its part up to ``snapshot`` (a commit or a tag)."""
        log = _read(self.spark, f"{self.path}/commits", COMMITS)
        if snapshot is None:
            return log
        tagged = _read(self.spark, f"{self.path}/tags", TAGS).filter(F.col("tag") == snapshot).select("commit").first()
        last = log.filter(F.col("commit") == (tagged["commit"] if tagged else snapshot)).agg(F.max("seq")).first()[0]
        if last is None:
            raise KeyError(snapshot)
        return log.filter(F.col("seq") <= F.lit(last))

    def version(self) -> int:
        """The highest number that a commit has claimed."""
        return max((int(n) for n in names(self.spark, f"{self.path}/claims") if n.isdigit()), default=0)

    def commit(self, rows: DataFrame, mode: str, run_id: str, day: datetime.date | None = None, expected: int | None = None) -> str:
        """Write rows (whole tiles) and then the commit that makes them visible; returns its id.

        ``expected`` is the version that the rows were made from (now, if None).  If
        another writer has claimed the next number since, nothing becomes visible, the
        written files are deleted and CommitConflictError is raised.
        """
        number = (self.version() if expected is None else expected) + 1
        name = uuid.uuid4().hex
        rows.repartition("zone", "year", "tile").write.option("compression", "zstd").partitionBy("zone", "year").parquet(f"{self.path}/data/commit={name}")
        written = self.spark.read.schema(self.schema).parquet(f"{self.path}/data/commit={name}")
        if not claimed(self.spark, f"{self.path}/claims/{number}"):
            verified_delete(self.spark, f"{self.path}/data/commit={name}")
            raise CommitConflictError(f"commit {number} of {self.path} is another writer's")
        parent = self.commits().agg(F.max_by("commit", "seq")).first()[0]
        log = written.groupBy("zone", "year").agg(F.array_sort(F.collect_set("tile")).alias("tiles"))
        at = datetime.datetime.now(datetime.UTC).replace(tzinfo=None)
        entry = log.select(F.lit(name).alias("commit"), F.lit(number).cast("long").alias("seq"), F.lit(parent).alias("parent"), F.lit(at).cast("timestamp").alias("at"), F.lit(mode).alias("mode"), F.lit(run_id).alias("run_id"), "zone", F.col("year").cast("int").alias("year"), "tiles", F.lit(day).cast("date").alias("newest_day"))
        entry.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        return name

    def read(self, snapshot: str | None = None) -> DataFrame:
        """Current rows: each tile from the newest commit of the snapshot that wrote it."""
        log = self.commits(snapshot).select("commit", "seq", "zone", "year", F.explode("tiles").alias("tile"))
        owner = log.groupBy("zone", "year", "tile").agg(F.max_by("commit", "seq").alias("commit"))
        if owner.isEmpty():
            return self.spark.createDataFrame([], self.schema)
        data = self.spark.read.schema(self.schema + ", commit string").parquet(f"{self.path}/data")
        return data.join(owner, ["zone", "year", "tile", "commit"], "left_semi").drop("commit")

    def append_day(self, rows: DataFrame, day: datetime.date, run_id: str) -> str:
        """Append one day; a day at or before the newest stored one is refused, also if another writer adds it meanwhile."""
        expected = self.version()
        newest = self.commits().agg(F.max("newest_day")).first()[0]
        if newest is not None and day <= newest:
            raise (DuplicateDateError if day == newest else NonMonotonicDateError)(f"{day} is not after {newest}")
        return self.commit(rows, "append", run_id, day, expected)

    def merge_owned(self, rows: DataFrame, key: list[str], owned: str, run_id: str) -> str:
        """Masked merge: owned pixels of ``rows`` replace stored ones of the tiles they touch; the rest stays."""
        expected = self.version()
        touched = rows.select("zone", "year", "tile").distinct()
        old = self.read().join(touched, ["zone", "year", "tile"], "left_semi")
        whole = ["zone", "year", "tile", *key]
        columns = [c for c in old.columns if c not in whole]
        new = rows.filter(F.col(owned)).select(*whole, F.struct(*columns).alias("__new"))
        joined = old.select(*whole, F.struct(*columns).alias("__old")).join(new, whole, "full")
        merged = joined.select(*whole, *[F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(f"__old.{c}")).alias(c) for c in columns])
        return self.commit(merged, "holes", run_id, expected=expected)

    def tag(self, name: str, commit: str) -> None:
        """Name a commit, once."""
        if not _read(self.spark, f"{self.path}/tags", TAGS).filter(F.col("tag") == name).isEmpty():
            raise ValueError(f"tag {name} exists")
        self.spark.createDataFrame([(name, commit)], TAGS).coalesce(1).write.mode("append").parquet(f"{self.path}/tags")

    def collect_garbage(self) -> int:
        """Delete the data of expired commits; how many there were."""
        gone = [r["commit"] for r in self.expired().collect()]  # commit ids alone
        for name in gone:
            verified_delete(self.spark, f"{self.path}/data/commit={name}")
        return len(gone)

    def expired(self) -> DataFrame:
        """Commits of which no tile is current, neither now nor in any tagged snapshot."""
        log = self.commits().select("commit", "seq", "zone", "year", F.explode("tiles").alias("tile"))
        tagged = _read(self.spark, f"{self.path}/tags", TAGS).join(log.select("commit", "seq"), "commit").select(F.col("seq").alias("upto"))
        snapshots = tagged.union(log.agg(F.max("seq").alias("upto"))).distinct()
        current = log.join(snapshots, F.col("seq") <= F.col("upto")).groupBy("upto", "zone", "year", "tile").agg(F.max_by("commit", "seq").alias("commit"))
        return log.select("commit").distinct().join(current.select("commit"), "commit", "left_anti")
