"""A stored blocking index: a run compares its batch with all articles before it, and shuffles the batch alone."""

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.dates import within_hours
from ..sources.snapshots import RunStore, Snapshot
from ..tables import materialise
from . import dedup
from .components import Components, no_components, with_edges

#: Buckets of the index, no fewer than the shuffle partitions of the runs that read it, or Spark shuffles the index too.
BUCKETS = 1024
#: Windows in a span of time. The longer a span, the fewer spans a window touches: an article asks in 1 + 2 / WINDOWS of them.
WINDOWS = 4
#: Parts that the articles of a key and span are dealt to where a run has over CROWD of one, so that a key which a third of all articles have is no single task.
PARTS, CROWD = 4, 1000


@dataclass(frozen=True)
class Added:
    """What a run wrote: the folder partition that has its rows, the first and last span of time in them (null without any), and the parts they are dealt to."""

    attempt: str
    low: int | None
    high: int | None
    parts: int = 1


class BlockIndex:
    """Postings (``key``, ``span``, ``part``: an article's number, source, time and sizes), sets and titles by ``ord``, as bucketed tables beside a run store.

    Each run appends its articles as one partition, ``attempt``, with a name of its own, and the store's table ``indexed``
    says which attempts count: what a dead run left is never read. A run joins its batch with the buckets, so the index is
    read in place; only attempts whose spans touch the batch's are read, so what is read grows with the window and not with
    the corpus. ``indexed`` is one bucket, so of two runs at once the later is refused: neither had seen the other's articles.

    Asking takes a row for each key, span that the window touches and part. Only a run that has a crowd deals its rows to
    parts, and only where such a run is near are they asked for, so without crowds a batch asks in hardly more rows than it has keys.

    ``threshold`` and ``hours`` belong to the index, since its keys and spans follow from them. The tables and the
    attempts that a run reads are registered in the session's catalogue by their place, so a new session finds them again.
    """

    def __init__(self, store: RunStore, threshold: float = dedup.THRESHOLD, hours: int = dedup.WINDOW_HOURS, buckets: int = BUCKETS, parts: int = PARTS, crowd: int = CROWD):
        self.store, self.spark, self.threshold, self.hours, self.buckets, self.parts, self.crowd = store, store.spark, threshold, hours, buckets, parts, crowd

    def _table(self, name: str, schema: StructType, key: str) -> str:
        place = f"{self.store.root}/index/{name}"
        table = f"tidewell_{name}_{hashlib.md5(place.encode()).hexdigest()}"
        if not self.spark.catalog.tableExists(table):
            columns = StructType([*schema.fields, StructField("attempt", StringType())]).toDDL()
            self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (attempt) CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.buckets} BUCKETS LOCATION '{place}'")
        return table

    def _read(self, name: str, like: DataFrame, key: str, attempts: list[str]) -> DataFrame:
        """The rows of these attempts; the session's catalogue is told of them, for another session may have written them."""
        table = self._table(name, like.schema, key)
        if attempts:
            self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(f"PARTITION (attempt = '{a}')" for a in attempts))
        return self.spark.table(table).where(F.col("attempt").isin(attempts))

    def _span(self, hours: int = 0) -> Column:
        """The span of time that an article is in; that of the moment so many hours after it."""
        return F.floor((F.unix_seconds("at") + 3600 * hours) / F.lit(3600 * self.hours * WINDOWS))

    def _postings(self, prepared: DataFrame, parts: int = 1) -> DataFrame:
        rows = dedup.meeting_keys(prepared, self.threshold).where(F.size("met_by") > 0)
        # Keys by their hash: two that fall together bring pairs that are scored like all others.
        key, part = F.explode(F.transform("met_by", lambda k: F.xxhash64(k))), F.pmod(F.xxhash64("ord"), F.lit(parts)).cast("int")
        return rows.select(key.alias("key"), self._span().alias("span"), part.alias("part"), "ord", "source", "at", F.size("brands").alias("n_brands"), F.size("vehicles").alias("n_vehicles"))

    def _asked(self, prepared: DataFrame, parts: int) -> DataFrame:
        """The postings of a batch in every span that is within the window, and in every part."""
        rows = self._postings(prepared).withColumn("span", F.explode(F.sequence(self._span(-self.hours), self._span(self.hours))))
        return rows if parts == 1 else rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def _sets(self, prepared: DataFrame) -> DataFrame:
        return prepared.select("ord", self._span().alias("span"), "id", "brands", "vehicles", "categories")

    def _titles(self, prepared: DataFrame) -> DataFrame:
        return prepared.select("ord", self._span().alias("span"), "title", "letters")

    def _append(self, rows: DataFrame, name: str, key: list[str], attempt: str) -> None:
        table = self._table(name, rows.schema, ", ".join(key))
        # Dealt as the buckets are, so each bucket is one file of the attempt.
        rows.withColumn("attempt", F.lit(attempt)).repartition(self.buckets, *key).write.insertInto(table)

    def add(self, base: Snapshot, prepared: DataFrame) -> tuple[Added, DataFrame]:
        """Write what of ``prepared`` (``dedup.prepare``) the index of ``base`` lacks, and return what was written, too.

        An article comes once: one whose ``ord`` is there already, with a time in the same window, counts as it came first,
        and of repeated rows in the batch one counts. Articles without ``ord`` are left out.
        """
        batch = prepared.drop("tokens").where("ord IS NOT NULL")
        low, high = self._spans(batch)
        batch = batch.dropDuplicates(["ord"])
        if known := [a for a, _ in self._attempts(base, low, high)]:
            titles = self._read("titles", self._titles(prepared), "ord", known)
            batch = batch.join(titles.select("ord"), "ord", "left_anti").select(batch.columns)
        batch = materialise(batch, "batch")
        low, high = self._spans(batch)
        attempt, parts = uuid.uuid4().hex, self.parts if self._crowded(batch) else 1
        if low is not None:
            self._append(self._postings(batch, parts), "postings", ["key", "span", "part"], attempt)
            self._append(self._sets(batch), "sets", ["ord"], attempt)
            self._append(self._titles(batch), "titles", ["ord"], attempt)
        return Added(attempt, low, high, parts), batch

    def _spans(self, rows: DataFrame) -> tuple[int | None, int | None]:
        return tuple(rows.select(self._span().alias("span")).agg(F.min("span"), F.max("span")).first())

    def _crowded(self, batch: DataFrame) -> bool:
        """Whether any key has over ``crowd`` articles in a span. Keys are counted only if so many articles are in one."""
        most = lambda rows, *by: rows.groupBy(*by).count().agg(F.max("count")).first()[0] or 0
        return most(batch.select(self._span().alias("span")), "span") > self.crowd and most(self._postings(batch), "key", "span") > self.crowd

    def _attempts(self, base: Snapshot, low: int | None, high: int | None) -> list[tuple[str, int]]:
        """The attempts that count in ``base`` and have articles within a window of these spans, with their parts: one for each run of that time."""
        if "indexed" not in base.tables or low is None:
            return []
        near = self.store.read("indexed", base).where((F.col("high") >= low - 1) & (F.col("low") <= high + 1))
        return [tuple(r) for r in near.select("attempt", "parts").collect()]

    def _near(self, base: Snapshot, added: Added) -> dict[str, int]:
        return {added.attempt: added.parts} | dict(self._attempts(base, added.low, added.high))

    def candidates(self, base: Snapshot, added: Added, batch: DataFrame) -> DataFrame:
        """Pairs ``a``, ``b`` (smaller ``ord`` first) of the batch with articles before it, and within it, as ``dedup.hopeful_pairs`` finds them.

        The batch's own postings are in the index by then, so one join finds both: a pair within the batch is met from
        both sides and counts from the later one's.
        """
        near = self._near(base, added)
        rows = self._read("postings", self._postings(batch), "key, span, part", list(near))
        if added.low is not None:
            rows = rows.where(F.col("span").between(added.low - 1, added.high + 1))
        met_by = ["key", "span", "part"]
        other = rows.select(*met_by, *(F.col(c).alias(f"old_{c}") for c in rows.columns if c not in (*met_by, "attempt")), (F.col("attempt") == added.attempt).alias("own"))
        met = other.join(self._asked(batch, max(near.values())), met_by).where(
            F.when(F.col("own"), F.col("old_ord") < F.col("ord")).otherwise(F.col("old_ord") != F.col("ord")) & ~F.col("old_source").eqNullSafe(F.col("source")) & within_hours(F.col("old_at"), F.col("at"), self.hours)
        )
        # A pair is met under each key in common; it counts once, and only if its sizes allow it, before any set is read.
        able = met.where(dedup.may_reach(self.threshold, *(F.col(c) for c in ("old_n_brands", "n_brands", "old_n_vehicles", "n_vehicles"))))
        pairs = able.select(F.least("old_ord", "ord").alias("a_ord"), F.greatest("old_ord", "ord").alias("b_ord")).distinct()
        return dedup.with_sets(pairs, self._read("sets", self._sets(batch), "ord", list(near)))

    def pairs(self, base: Snapshot, added: Added, batch: DataFrame) -> DataFrame:
        """``dedup.scored_pairs`` of the batch with everything before it and within it; titles are read from their buckets."""
        titles = self._read("titles", self._titles(batch), "ord", list(self._near(base, added)))
        return dedup.score_pairs(self.candidates(base, added, batch), titles.select("ord", "title", "letters"), self.threshold)


def duplicate_run(index: BlockIndex, run: str, articles: DataFrame, buckets: int = BUCKETS) -> Snapshot:
    """A run's batch of articles into the index, its pairs into ``pairs`` and their components into ``labels`` and ``merges``, all or nothing.

    Runs in any order, of any size, give the pairs and components of all their articles together. A run that counts
    already changes nothing; one that died is done again whole.
    """
    store = index.store
    if (done := store.find(run)) is not None:
        return done
    base = store.snapshot()
    added, batch = index.add(base, dedup.prepare(articles))
    found = materialise(index.pairs(base, added, batch).withColumn("run", F.lit(run)), "run-pairs") if added.low is not None else store.spark.createDataFrame([], "a string, b string, a_ord long, b_ord long, score double, title double, run string")
    if "labels" in base.tables:
        ends = found.select(F.explode(F.array("a_ord", "b_ord")).alias("id"))
        before = Components(store.matching(base, "labels", ends), store.read("merges", base))
    else:
        before = no_components(store.spark)
    after = with_edges(before, found, "a_ord", "b_ord")
    indexed = store.spark.createDataFrame([(run, added.attempt, added.low, added.high, added.parts)], "run string, attempt string, low long, high long, parts int")
    return store.commit(base, run, {
        "indexed": store.upsert(base, "indexed", indexed, ["run"], buckets=1), "pairs": store.upsert(base, "pairs", found, ["a_ord", "b_ord"], buckets=buckets),
        "labels": store.upsert(base, "labels", after.labels, ["id"], buckets=buckets), "merges": store.upsert(base, "merges", after.merges, ["component"], buckets=buckets),
    })
