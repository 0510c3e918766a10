"""Write patterns: versioned tables, one manifest a run, and the run log.

A table is a folder of parts (folders of Parquet files) and of numbered commits,
each of which names the parts of one version.  Nothing is overwritten: a load
writes new parts and then a commit, so a reader sees the old version or the
new one, and a failed load leaves the old one in place.  A version may keep
parts of the one before it, so what a load does not touch is not rewritten.

Over the tables, a manifest names the version of every table that belongs
together.  It is numbered after the one it was built on and created only if
that number is free, so two runs from one state cannot both be committed.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.sources.commits import commits, publish, publish_next, read_commit


# ------------------------------------------------------------------------ tables
def write_part(df: DataFrame, base: str, partition_by: list[str] | None = None, label: str = "v") -> str:
    """Write ``df`` as a part of the table at ``base``; no reader sees it yet."""
    name = f"{label}-{uuid.uuid4().hex[:12]}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{base}/{name}", compression="zstd")
    return name


def commit_parts(spark: SparkSession, base: str, parts: list[str]) -> int:
    """Make ``parts`` the current version of the table."""
    return publish_next(spark, f"{base}/_commits", json.dumps(parts))


def current_parts(spark: SparkSession, base: str) -> list[str] | None:
    have = commits(spark, f"{base}/_commits")
    return json.loads(read_commit(spark, have[max(have)])) if have else None


def read_parts(spark: SparkSession, base: str, parts: list[str]) -> DataFrame:
    """The rows of some parts of a table (written by one schema)."""
    frames = [spark.read.parquet(f"{base}/{p}") for p in parts]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def read_current(spark: SparkSession, base: str) -> DataFrame:
    parts = current_parts(spark, base)
    if parts is None:
        raise FileNotFoundError(f"no committed version under {base}")
    return read_parts(spark, base, parts)


def has_version(spark: SparkSession, base: str) -> bool:
    return bool(commits(spark, f"{base}/_commits"))


def overwrite(df: DataFrame, base: str, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as a new version of the table at ``base`` and commit it."""
    version = write_part(df, base, partition_by)
    commit_parts(df.sparkSession, base, [version])
    return version


# --------------------------------------------------------------------- manifests
class Conflict(RuntimeError):
    """Another run has been committed since this one began."""


@dataclass(frozen=True)
class Version:
    """A table's version: its parts by kind, and the largest key ever given."""

    parts: dict[str, list[str]]
    max_key: int = 0

    def all_parts(self) -> list[str]:
        return [p for kind in sorted(self.parts) for p in self.parts[kind]]


@dataclass(frozen=True)
class Manifest:
    """One consistent state of all tables."""

    number: int = 0
    tables: dict[str, Version] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({"number": self.number, "tables": {
            name: {"parts": v.parts, "max_key": v.max_key} for name, v in sorted(self.tables.items())}})

    @classmethod
    def from_json(cls, text: str) -> "Manifest":
        stored = json.loads(text)
        return cls(stored["number"], {name: Version(v["parts"], v["max_key"])
                                      for name, v in stored["tables"].items()})


class Store:
    """Tables under one folder, read through manifests."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark, self.base = spark, base.rstrip("/")
        self.folder = f"{self.base}/_manifests"

    def path(self, table: str) -> str:
        return f"{self.base}/{table}"

    def latest(self) -> Manifest:
        """The last committed state (number 0, without tables, before the first)."""
        have = commits(self.spark, self.folder)
        return self.at(max(have)) if have else Manifest()

    def at(self, number: int) -> Manifest:
        return Manifest.from_json(read_commit(self.spark, commits(self.spark, self.folder)[number]))

    def read(self, table: str, version: Version, kinds: list[str] | None = None) -> DataFrame:
        """A table's rows in one version, or those of some kinds of its parts."""
        parts = version.all_parts() if kinds is None else [p for k in kinds for p in version.parts.get(k, [])]
        return read_parts(self.spark, self.path(table), parts)

    def write(self, df: DataFrame, table: str, kind: str = "all", partition_by: list[str] | None = None) -> str:
        return write_part(df, self.path(table), partition_by, kind)

    def commit(self, built_on: Manifest, changed: dict[str, Version]) -> Manifest:
        """The state ``built_on`` with ``changed`` tables as the next one."""
        after = Manifest(built_on.number + 1, {**built_on.tables, **changed})
        if not publish(self.spark, self.folder, after.number, after.to_json()):
            raise Conflict(f"state {after.number} of {self.base} was committed by another run")
        return after


# ------------------------------------------------------------------------ run log
def append_log(df: DataFrame, path: str) -> None:
    """Append run-log rows (tiny, one file per append)."""
    df.coalesce(1).write.mode("append").parquet(path)
