"""Stored tables: Parquet folders per write, listed by a small snapshot file.

Layout of a table below the store's root::

    <table>/data/write=<token>/period=202607/part-*.parquet
    <table>/snapshots/7          columns and, per period, the write that holds it

A write puts its rows in a folder of its own and then publishes one snapshot file; readers
follow the newest snapshot, so they see all of a write or nothing of it. A failed job leaves
only unreferenced folders. A renamed file must appear whole; that only one writer publishes a
version is seen to by claims, not by the file system.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import period_number
from tidemark.schemas import TableSpec
from tidemark.session import DENSE
from tidemark.sources.exports import between_days

WHOLE = 0
# Age after which a claim is taken for one of a writer that died.
CLAIM_HOURS = 1.0


class ConcurrentWrite(RuntimeError):
    """Another writer published a snapshot first; run the write again."""


class SnapshotStore:
    """Reads and replaces whole periods of the tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, *parts: object):
        text = "/".join([self.root, *map(str, parts)])
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def note(self, *parts: object, text: str) -> str:
        """The text kept below ``root`` under this name: the given one if there was none yet."""
        fs, path = self._fs(), self._path(*parts)
        if not fs.exists(path):
            aside = self._path(*parts[:-1], f".{uuid.uuid4().hex}")
            stream = fs.create(aside, False)
            try:
                stream.write(bytearray(text.encode()))
            finally:
                stream.close()
            fs.rename(aside, path)
        stream = fs.open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def version(self, spec: TableSpec) -> int:
        """Newest published version, 0 for a table that was never written."""
        folder = self._path(spec.name, "snapshots")
        if not self._fs().exists(folder):
            return 0
        names = [status.getPath().getName() for status in self._fs().listStatus(folder)]
        return max((int(name) for name in names if name.isdigit()), default=0)

    def _snapshot(self, spec: TableSpec, version: int) -> dict:
        if version == 0:
            return {"columns": None, "grain": None, "periods": {}}
        stream = self._fs().open(self._path(spec.name, "snapshots", version))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def _publish(self, spec: TableSpec, version: int, snapshot: dict) -> None:
        """Write aside, then rename: the name appears at once and only for one writer.

        Every writer of a version first leaves a claim and then looks for others. Of two, the
        one that looks later sees both, so at most one goes on; that holds where testing for a
        file and renaming to it are two steps. Writers that see another's claim give up.
        """
        fs = self._fs()
        claims = self._path(spec.name, "claims", version)
        mine = self._path(spec.name, "claims", version, uuid.uuid4().hex)
        aside = self._path(spec.name, "snapshots", f".{uuid.uuid4().hex}")
        final = self._path(spec.name, "snapshots", version)
        fs.create(mine, False).close()
        try:
            oldest = (time.time() - CLAIM_HOURS * 3600) * 1000
            others = [s for s in fs.listStatus(claims) if s.getPath().getName() != mine.getName()]
            if any(s.getModificationTime() >= oldest for s in others) or fs.exists(final):
                raise ConcurrentWrite(f"{spec.name} version {version}")
            stream = fs.create(aside, False)
            try:
                stream.write(bytearray(json.dumps(snapshot).encode()))
            finally:
                stream.close()
            if not fs.rename(aside, final):
                raise ConcurrentWrite(f"{spec.name} version {version}")
        finally:
            fs.delete(mine, False)

    def columns(self, spec: TableSpec) -> T.StructType:
        """Stored columns plus those the table gained or kept from earlier contracts."""
        known = self._snapshot(spec, self.version(spec))["columns"]
        columns = T.StructType(list(spec.stored))
        if known:
            earlier = T.StructType.fromJson(known)
            kinds = {field.name: field.dataType for field in columns}
            for field in earlier:
                if kinds.get(field.name, field.dataType) != field.dataType:
                    raise ValueError(f"{spec.name}: {field.name} is stored as {field.dataType.simpleString()}")
            extra = [field for field in earlier if field.name not in columns.names]
            columns = T.StructType([*columns, *extra])
        return columns

    def ensure(self, specs: Iterable[TableSpec]) -> None:
        """Create missing tables and add new nullable columns; nothing is dropped or retyped."""
        for spec in specs:
            version = self.version(spec)
            snapshot = self._snapshot(spec, version)
            columns = self.columns(spec).jsonValue()
            if snapshot["columns"] != columns:
                self._publish(spec, version + 1, {**snapshot, "columns": columns})

    def last_batch(self, spec: TableSpec, source: str, version: int | None = None) -> int:
        """Number of the last batch of a numbered source that the table holds, -1 for none."""
        at = self.version(spec) if version is None else version
        return self._snapshot(spec, at).get("batches", {}).get(source, -1)

    def notes(self, spec: TableSpec, version: int | None = None) -> dict:
        """What the writers of the table noted with it."""
        return self._snapshot(spec, self.version(spec) if version is None else version).get("notes", {})

    def writes(self, spec: TableSpec, version: int | None = None) -> dict[int, str]:
        """The write that holds each period: what differs between two versions has changed."""
        at = self.version(spec) if version is None else version
        return {int(period): token for period, token in self._snapshot(spec, at)["periods"].items()}

    def sizes(self, spec: TableSpec, periods: Iterable[int], version: int | None = None) -> dict[int, int]:
        """Bytes stored of those periods that exist."""
        held = self.writes(spec, version)
        folders = {p: self._path(spec.name, "data", f"write={held[p]}", f"period={p}") for p in periods if p in held}
        return {p: self._fs().getContentSummary(path).getLength() for p, path in folders.items()}

    def read(
        self,
        spec: TableSpec,
        periods: Iterable[int] | None = None,
        with_period: bool = False,
        version: int | None = None,
    ) -> DataFrame:
        """The table, or only some of its periods; older files show new columns as null."""
        snapshot = self._snapshot(spec, self.version(spec) if version is None else version)
        wanted = None if periods is None else {str(period) for period in periods}
        paths = [
            f"{self.root}/{spec.name}/data/write={token}/period={period}"
            for period, token in snapshot["periods"].items()
            if wanted is None or period in wanted
        ]
        names = [*self.columns(spec).names, *(["period"] if with_period else [])]
        schema = T.StructType([*self.columns(spec), T.StructField("period", T.IntegerType())])
        if not paths:
            return self.spark.createDataFrame([], schema).select(*names)
        reader = self.spark.read.schema(schema)
        table = reader.option("basePath", f"{self.root}/{spec.name}/data").parquet(*paths)
        return table.select(*names)

    def read_days(
        self, spec: TableSpec, start: date | None = None, end: date | None = None
    ) -> DataFrame:
        """Rows of an inclusive day range, listing only the folders that can hold them."""
        known = [int(p) for p in self._snapshot(spec, self.version(spec))["periods"]]
        if start is not None:
            known = [p for p in known if p >= _number(start, spec.grain)]
        if end is not None:
            known = [p for p in known if p <= _number(end, spec.grain)]
        return between_days(self.read(spec, known), spec, start, end)

    def write_periods(
        self,
        spec: TableSpec,
        rows: DataFrame,
        base: int,
        keep_others: bool = True,
        arranged: bool = False,
        only: set[int] | None = None,
        once: tuple[str, int] | None = None,
        drop: set[int] = frozenset(),
        notes: dict | None = None,
    ) -> list[int]:
        """Replace the periods present in ``rows`` (with ``period``) on top of version ``base``.

        Rows are spread by period; adaptive execution splits a period that is larger than a
        partition should be and merges small ones. Within files rows are ordered by key, so a
        filter on an entity skips row groups. ``arranged`` rows lie as they should already.
        Nothing is published if a period outside ``only`` was written. ``once`` is the (source,
        number) of the batch that the version then holds, ``drop`` lists periods that go unless
        they were written, and ``notes`` are kept with the version.
        """
        columns = self.columns(spec)
        earlier = self._snapshot(spec, base) if keep_others else {"grain": None, "periods": {}}
        if earlier["periods"] and earlier["grain"] != spec.grain:
            raise ValueError(f"{spec.name} is stored by {earlier['grain']}, not by {spec.grain}")
        token = uuid.uuid4().hex
        target = f"{self.root}/{spec.name}/data/write={token}"
        entity_first = sorted(spec.key, key=lambda name: not name.endswith("_id"))
        shaped = evolve(rows, columns, keep=("period",))
        if not arranged:
            shaped = shaped.hint("rebalance", "period").sortWithinPartitions("period", *entity_first)
        shaped.write.partitionBy("period").options(**DENSE).parquet(target)
        written = self._written_periods(target)
        if only is not None and not only.issuperset(written):
            raise RuntimeError(f"{spec.name}: periods {sorted(set(written) - only)} were not expected")
        kept = {period: held for period, held in earlier["periods"].items() if int(period) not in drop}
        periods = {**kept, **{str(period): token for period in written}}
        snapshot = {
            "columns": columns.jsonValue(),
            "grain": spec.grain,
            "periods": periods,
            "batches": {**earlier.get("batches", {}), **({once[0]: once[1]} if once else {})},
            "notes": {**earlier.get("notes", {}), **(notes or {})},
        }
        self._publish(spec, base + 1, snapshot)
        return written

    def replace(self, spec: TableSpec, rows: DataFrame) -> None:
        """Make ``rows`` the whole table."""
        whole = with_period(rows, spec)
        self.write_periods(spec, whole, self.version(spec), keep_others=False)

    def expire(self, spec: TableSpec, keep: int = 2, older_than_hours: float = 24.0) -> list[str]:
        """Delete all but the ``keep`` newest snapshots and the data folders only they use.

        Young folders stay: a running write may be about to publish them. Snapshots go first, so
        that none is left that points to a deleted folder.
        """
        newest = self.version(spec)
        used = set()
        for version in range(max(1, newest - keep + 1), newest + 1):
            used.update(self._snapshot(spec, version)["periods"].values())
        data = self._path(spec.name, "data")
        if not self._fs().exists(data):
            return []
        oldest_kept = (time.time() - older_than_hours * 3600) * 1000
        for status in self._fs().listStatus(self._path(spec.name, "snapshots")):
            name = status.getPath().getName()
            if name.isdigit() and int(name) <= newest - keep:
                if status.getModificationTime() < oldest_kept:
                    self._fs().delete(status.getPath(), False)
                else:
                    used.update(self._snapshot(spec, int(name))["periods"].values())
        claims = self._path(spec.name, "claims")
        for status in self._fs().listStatus(claims) if self._fs().exists(claims) else []:
            if int(status.getPath().getName()) <= newest:  # published: nobody claims it any more
                self._fs().delete(status.getPath(), True)
        gone = []
        for status in self._fs().listStatus(data):
            token = status.getPath().getName().removeprefix("write=")
            if token not in used and status.getModificationTime() < oldest_kept:
                self._fs().delete(status.getPath(), True)
                gone.append(token)
        return gone

    def _written_periods(self, folder: str) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        names = [status.getPath().getName() for status in self._fs().listStatus(path)]
        return sorted(int(n.split("=")[1]) for n in names if n.startswith("period="))


def _number(day: date, grain: str) -> int:
    number = day.year * 100 + day.month
    return number * 100 + day.day if grain == "day" else number


def with_period(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Adds the partition value; dimensions and control tables are one period."""
    if spec.day is None:
        return rows.withColumn("period", F.lit(WHOLE))
    return rows.withColumn("period", period_number(F.col(spec.day), spec.grain))


def evolve(rows: DataFrame, columns: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Shape rows to the given columns: cast known ones, add missing ones as typed nulls."""
    shaped = [
        F.col(field.name).cast(field.dataType).alias(field.name)
        if field.name in rows.columns
        else F.lit(None).cast(field.dataType).alias(field.name)
        for field in columns
    ]
    return rows.select(*shaped, *keep)
