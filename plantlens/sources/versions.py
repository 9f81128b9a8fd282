"""Versions of a folder of tables.

A writer puts the tables of a version into a folder of its own, which no
reader looks at, and commits the version last: one record, a line of text
in a folder of its own below ``<root>/versions`` (writers that commit at the
same time must not share an output folder: the first to end would clear the
other's temporary files). Spark's file committer renames the finished file
into place, so a record is there whole or not at all, and with it all that
it names. A writer that dies before leaves a folder that nothing refers to.

Readers take the newest record once and read only what it names, so all
tables they see belong together however many versions are committed
meanwhile. Names start with the time at which a version was begun: of two
writers the one that began later, and so read newer input, stays current,
even if the other ends last.

A record names the parts of every table: a folder of this or of an earlier
version, and for tables kept by day which days of it hold or don't. So a
version may take most of its days from the one before (``plans.correct``).
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORDS = "versions"
ACCEPTED, DEFECTS = "accepted", "defects"  # columns of judged rows
LASTING = ("streamed", "compacted")  # facts that hold for versions made from this one


@dataclass(frozen=True)
class Part:
    """A folder below the root, and which of its days count: those in
    ``only``, or all that are not in ``without``. ``judged``: the folder
    holds judged rows (``operators.quarantine``), of which the accepted
    ones count."""

    folder: str
    only: tuple[str, ...] | None = None
    without: tuple[str, ...] = ()
    judged: bool = False

    def minus(self, days: Iterable[str]) -> "Part | None":
        """This part without some days; None if no day is left."""
        if self.only is None:
            return replace(self, without=tuple(sorted({*self.without, *days})))
        left = tuple(d for d in self.only if d not in set(days))
        return replace(self, only=left) if left else None

    def rows(self, df: DataFrame, day: str | None) -> DataFrame:
        """The rows that count, of the folder's table kept by ``day``: both
        tests are on partition columns, so other folders are not read."""
        if self.judged:
            df = df.where(ACCEPTED).drop(ACCEPTED, DEFECTS)
        if day is None or (self.only is None and not self.without):
            return df
        text = F.col(day).cast("string")
        return df.where(text.isin(*self.only) if self.only is not None else ~text.isin(*self.without))


@dataclass(frozen=True)
class Version:
    """One committed version. ``parts`` by table; a table without an entry
    is the folder of its name in the version's own folder."""

    name: str
    zone: str
    parent: str | None = None
    parts: dict[str, tuple[Part, ...]] = field(default_factory=dict)
    facts: dict = field(default_factory=dict)  # what the writer wants to say about it

    def table(self, name: str) -> tuple[Part, ...]:
        return self.parts.get(name) or (Part(os.path.join(self.name, name)),)

    def lasting(self) -> dict:
        """The facts that a version made from this one takes over."""
        return {k: self.facts[k] for k in LASTING if k in self.facts}

    def line(self) -> str:
        parts = {table: [asdict(p) for p in own] for table, own in self.parts.items()}
        return f"{self.name} {self.zone} " + json.dumps(
            {"parent": self.parent, "parts": parts, "facts": self.facts}, sort_keys=True
        )

    @staticmethod
    def of(line: str) -> "Version":
        name, zone, *rest = line.split(" ", 2)
        more = json.loads(rest[0]) if rest else {}
        parts = {
            table: tuple(
                Part(p["folder"], p["only"] and tuple(p["only"]), tuple(p["without"]), p["judged"]) for p in own
            )
            for table, own in more.get("parts", {}).items()
        }
        return Version(name, zone, more.get("parent"), parts, more.get("facts", {}))


def begin() -> str:
    """The name of a new version."""
    return f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def records(spark: SparkSession, root: str) -> DataFrame | None:
    """(value): the lines of all committed versions; None without any."""
    try:
        return spark.read.option("recursiveFileLookup", True).text(os.path.join(root, RECORDS))
    except AnalysisException:  # no such folder
        return None


def commit(spark: SparkSession, root: str, version: Version) -> Version:
    """Make a version, all written, the current one."""
    line = spark.createDataFrame([(version.line(),)], "value string").coalesce(1)
    line.write.text(os.path.join(root, RECORDS, version.name))
    return version


def current(spark: SparkSession, root: str, name: str | None = None) -> Version | None:
    """The newest committed version, or the one of that name; None without."""
    lines = records(spark, root)
    if lines is None:
        return None
    if name is not None:
        lines = lines.where(F.substring_index("value", " ", 1) == name)
    line = lines.agg(F.max("value")).first()[0]
    return None if line is None else Version.of(line)


def session_zone(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.session.timeZone")
