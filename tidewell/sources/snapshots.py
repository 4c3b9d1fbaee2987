"""Runs that count once: a manifest names the files of all tables of a version and comes into place by one step that never overwrites."""

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import store

#: Buckets of a new table: about a thousandth of it is rewritten for a row.
BUCKETS = 1024
#: How often a run whose files nobody else touched is put on top of another run that was faster.
TRIES = 20


class Conflict(RuntimeError):
    """Another run has changed the same buckets since; do the run again on the new snapshot."""


@dataclass(frozen=True)
class Table:
    """One version of a table: its rows are dealt by ``key`` to ``buckets``; ``files`` has the folder of each that isn't empty."""

    schema: StructType
    key: tuple[str, ...]
    buckets: int
    files: dict[int, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Snapshot:
    version: int
    run: str | None
    tables: dict[str, Table]


def _bucket(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


class RunStore:
    """Tables under ``root``, a folder that all machines see. Readers take the newest snapshot, or keep the one they have.

    Data folders are written first, under names of their own; then one manifest makes a whole run count. A run that dies
    before leaves only folders that no manifest names, which ``remove_orphans`` deletes. The manifest comes into place by a
    rename, which in a distributed file system fails if the version is there, or by a hard link in a local one; an object
    store without such a step is no place for manifests.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        #: The runs of manifests that this process has read or written: a manifest never changes.
        self._runs: dict[int, str] = {}

    def versions(self) -> list[int]:
        """All versions that are still listed, oldest first."""
        place = self._path(f"{self.root}/manifests")
        if not self._fs.exists(place):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(place)]
        return sorted(int(n.split(".")[0]) for n in names if n.endswith(".json") and not n.startswith("."))

    def snapshot(self, version: int | None = None) -> Snapshot:
        """A version, or the newest; version 0 has no tables."""
        listed = self.versions()
        version = (listed[-1] if listed else 0) if version is None else version
        if version == 0:
            return Snapshot(0, None, {})
        stream = self._fs.open(self._path(self._manifest(version)))
        try:
            found = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        self._runs[version] = found["run"]
        tables = {n: Table(StructType.fromJson(t["schema"]), tuple(t["key"]), t["buckets"], {int(b): f for b, f in t["files"].items()}) for n, t in found["tables"].items()}
        return Snapshot(version, found["run"], tables)

    def read(self, name: str, snapshot: Snapshot | None = None) -> DataFrame:
        """The rows of a table in a snapshot."""
        table = (snapshot or self.snapshot()).tables[name]
        return self._rows(table, table.files.values())

    def matching(self, base: Snapshot, name: str, keys: DataFrame) -> DataFrame:
        """The rows whose key is in ``keys`` (columns named like the key). Only buckets that have one are read."""
        table = base.tables[name]
        keys = keys.select(*(F.col(k).cast(table.schema[k].dataType).alias(k) for k in table.key)).distinct()
        touched = [r[0] for r in keys.select(_bucket(table.key, table.buckets).alias("b")).distinct().collect()]  # as many as buckets at most
        rows = self._rows(table, [table.files[b] for b in sorted(touched) if b in table.files])
        return rows.join(keys, list(table.key), "left_semi")

    def upsert(self, base: Snapshot, name: str, new: DataFrame, key: Sequence[str], create_only: Sequence[str] = (), keep_known: Sequence[str] = (), as_of: Column | None = None, buckets: int = BUCKETS) -> Table:
        """What ``name`` is after ``new`` is merged into it, for ``commit``. Only buckets that have a row of ``new`` are read and written.

        ``store.upsert`` has the rules of the merge. A table that ``base`` lacks is made with ``buckets``.
        """
        table = base.tables.get(name) or Table(StructType(), tuple(key), buckets)
        if table.key != tuple(key):
            raise ValueError(f"{name} is dealt by {table.key}")
        # A run may come with other widths of numbers, which would also deal its keys otherwise.
        new = new.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in table.schema.fields if f.name in new.columns})
        dealt = new.withColumn("__bucket", _bucket(key, table.buckets))
        touched = sorted(r[0] for r in dealt.select("__bucket").distinct().collect())  # as many as buckets at most
        if not touched:
            return table if table.schema.fields else Table(new.schema, table.key, table.buckets)
        old = self._rows(table, [table.files[b] for b in touched if b in table.files]) if table.schema.fields else self.spark.createDataFrame([], new.schema)
        merged = store.upsert(old, new, key, create_only, keep_known, as_of)
        place = f"data/{name}/{uuid.uuid4().hex}"
        # A task writes whole buckets: as many files as buckets, none larger than its part of the table.
        merged.withColumn("__bucket", _bucket(key, table.buckets)).repartition("__bucket").write.partitionBy("__bucket").parquet(f"{self.root}/{place}")
        schema = StructType([*table.schema.fields, *(f for f in merged.schema.fields if f.name not in table.schema.names)])
        return Table(schema, table.key, table.buckets, table.files | {b: f"{place}/__bucket={b}" for b in touched})

    def commit(self, base: Snapshot, run: str, tables: dict[str, Table]) -> Snapshot:
        """Make the tables of a run count, all or none, once for each ``run``.

        If ``run`` counts already, its snapshot is returned. If other runs came in between, this one is put on top of them
        where they wrote no bucket that it wrote; else ``Conflict`` is raised.
        """
        for _ in range(TRIES):
            now = self.snapshot()
            if (done := self.find(run)) is not None:
                return done
            merged = dict(now.tables)
            for name, table in tables.items():
                was, other = base.tables.get(name), now.tables.get(name)
                if other is None or was is not None and was.files == other.files and was.schema == other.schema:
                    merged[name] = table
                    continue
                mine = {b: f for b, f in table.files.items() if was is None or was.files.get(b) != f}
                theirs = {b for b, f in other.files.items() if was is None or was.files.get(b) != f}
                if theirs & set(mine) or table.buckets != other.buckets:
                    raise Conflict(f"another run changed {name} after version {base.version}")
                schema = StructType([*other.schema.fields, *(f for f in table.schema.fields if f.name not in other.schema.names)])
                merged[name] = Table(schema, table.key, table.buckets, other.files | mine)
            made = Snapshot(now.version + 1, run, merged)
            if self._publish(made):
                return made
        raise Conflict(f"{TRIES} other runs were faster")

    def remove_orphans(self, keep: int = 10, older_than: float = 86_400.0) -> int:
        """Delete all manifests but the last ``keep``, and the data folders that those name nowhere and nobody wrote to for ``older_than`` seconds.

        Runs and readers that take longer than that, or hold older snapshots, must not be under way. Returns the folders deleted.
        """
        listed = self.versions()
        for version in listed[:-keep]:
            self._fs.delete(self._path(self._manifest(version)), False)
        used = {f.rsplit("/", 1)[0] for v in listed[-keep:] for t in self.snapshot(v).tables.values() for f in t.files.values()}
        place, removed = self._path(f"{self.root}/data"), 0
        for table in self._fs.listStatus(place) if self._fs.exists(place) else []:
            for folder in self._fs.listStatus(table.getPath()):
                name = f"data/{table.getPath().getName()}/{folder.getPath().getName()}"
                if name not in used and folder.getModificationTime() / 1000 <= time.time() - older_than:
                    removed += self._fs.delete(folder.getPath(), True)
        return removed

    def _manifest(self, version: int) -> str:
        return f"{self.root}/manifests/{version:012d}.json"

    def _rows(self, table: Table, files: Sequence[str]) -> DataFrame:
        places = [f"{self.root}/{f}" for f in files]
        return self.spark.read.schema(table.schema).parquet(*places) if places else self.spark.createDataFrame([], table.schema)

    def find(self, run: str) -> Snapshot | None:
        """The version in which a run counts, of those that are listed."""
        listed = self.versions()
        unread = [self._manifest(v) for v in listed if v not in self._runs]
        if unread:
            rows = self.spark.read.text(unread, wholetext=True).select(F.get_json_object("value", "$.version").cast("int"), F.get_json_object("value", "$.run"))
            self._runs.update(tuple(r) for r in rows.collect())  # a number and a name for each manifest
        found = [v for v in listed if self._runs[v] == run]
        return self.snapshot(found[0]) if found else None

    def _publish(self, made: Snapshot) -> bool:
        """Write the manifest beside its place and move it there, unless the version is taken. Whole or not at all."""
        tables = {n: {"schema": t.schema.jsonValue(), "key": list(t.key), "buckets": t.buckets, "files": t.files} for n, t in made.tables.items()}
        text = json.dumps({"version": made.version, "run": made.run, "tables": tables})
        staged, final = self._path(f"{self.root}/manifests/.{uuid.uuid4().hex}"), self._path(self._manifest(made.version))
        out = self._fs.create(staged, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        try:
            if self._fs.getUri().getScheme() != "file":
                return bool(self._fs.rename(staged, final))
            files = self.spark._jvm.java.nio.file
            at = lambda p: files.Path.of(p.toUri().getPath(), self.spark._sc._gateway.new_array(self.spark._jvm.java.lang.String, 0))
            try:
                files.Files.createLink(at(final), at(staged))
            except Exception as taken:
                if "FileAlreadyExistsException" in str(taken):
                    return False
                raise
            return True
        finally:
            self._fs.delete(staged, False)


def changed_rows(before: DataFrame, after: DataFrame, key: str = "id") -> DataFrame:
    """Rows of ``after`` that ``before`` lacks or has otherwise: what a run has to write of a table that it returns whole."""
    shared = [c for c in after.columns if c in before.columns and c != key]
    was = before.select(F.col(key).alias("__key"), *(F.col(c).alias(f"__{c}") for c in shared), F.lit(True).alias("__there"))
    joined = after.join(was, F.col(key).eqNullSafe(F.col("__key")), "left")
    same = reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in shared), F.coalesce("__there", F.lit(False)))
    for c in after.columns:
        if c not in before.columns:
            same &= F.col(c).isNull()
    return joined.where(~same).select(after.columns)
