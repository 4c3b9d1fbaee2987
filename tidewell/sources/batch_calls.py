"""Requests that a service answers in batches, later: submitted, polled, retried with growing pauses, expired; each answer counts once."""

from collections.abc import Callable, Iterator, Sequence
from datetime import datetime
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..tables import materialise
from .snapshots import RunStore, Snapshot

SIZE, RETRIES, PAUSE_SECONDS, MAX_AGE_SECONDS = 100, 3, 60, 86_400
#: Batches that are numbered together: what one task numbers is about this many batches, whatever the number of requests.
DEALT = 100
_RESULT = "batch_id string, request_id string, ok boolean, answer string"


class Service(Protocol):
    def submit(self, requests: DataFrame) -> None:
        """Take ``batch_id``, ``request_id``, ``prompt``. A batch that comes again, for a run died after it was taken, must change nothing."""

    def results(self, batches: DataFrame) -> DataFrame:
        """``batch_id``, ``request_id``, ``ok``, ``answer`` of those requests of the batches (``batch_id``) that have come to an end."""


class FolderService:
    """Batches in files of a shared folder that somebody else answers; answers land as a table (``request_id``, ``ok``, ``answer``).

    A file has many whole batches, one after another, so there are as many files as the requests fill, not one or more for
    each batch. A file comes into the folder whole: of a run that died on the way some batches are there, and the rest is added.
    """

    def __init__(self, folder: str, answers: DataFrame):
        self.folder, self.answers = folder, answers

    def _sent(self, spark: SparkSession) -> DataFrame:
        path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        schema = "request_id string, prompt string, batch_id string"
        there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
        return spark.read.schema(schema).parquet(self.folder) if there else spark.createDataFrame([], schema)

    def submit(self, requests: DataFrame) -> None:
        new = requests.join(self._sent(requests.sparkSession).select("batch_id").distinct(), "batch_id", "left_anti")
        new.select("request_id", "prompt", "batch_id").repartition("batch_id").sortWithinPartitions("batch_id").write.mode("append").parquet(self.folder)

    def results(self, batches: DataFrame) -> DataFrame:
        sent = self._sent(batches.sparkSession).join(batches, "batch_id", "left_semi")
        return sent.select("batch_id", "request_id").join(self.answers, "request_id").select("batch_id", "request_id", "ok", "answer")


class CallService:
    """A service behind two functions, called in tasks: ``submit(batch_id, request_ids, prompts)`` and ``poll(batch_id)``, which has (request_id, ok, answer) of what has ended.

    A task that is run again repeats its calls, so ``submit`` must know a batch by its id.
    """

    def __init__(self, submit: Callable[[str, Sequence[str], Sequence[str]], None], poll: Callable[[str], Sequence[tuple[str, bool, str | None]]]):
        self._submit, self._poll = submit, poll

    def submit(self, requests: DataFrame) -> None:
        call = self._submit

        def send(batch: pd.DataFrame) -> pd.DataFrame:
            ordered = batch.sort_values("request_id")
            call(batch["batch_id"].iloc[0], ordered["request_id"].tolist(), ordered["prompt"].tolist())
            return batch[["batch_id"]].head(1)

        requests.groupBy("batch_id").applyInPandas(send, "batch_id string").write.format("noop").mode("overwrite").save()

    def results(self, batches: DataFrame) -> DataFrame:
        call = self._poll

        def ask(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in parts:
                rows = [(b, *r) for b in part["batch_id"] for r in call(b)]
                yield pd.DataFrame(rows, columns=["batch_id", "request_id", "ok", "answer"])

        return batches.mapInPandas(ask, _RESULT)


class BatchCalls:
    """Requests in the table ``requests`` of a run store: ``waiting``, ``processing``, then ``succeeded``, ``errored``, ``expired`` or ``canceled``.

    Their texts are tables of their own, ``prompts`` and ``answers``, which are written when they come: a step that moves
    requests on rewrites their states, not their texts.
    ``tick`` is called again and again, by a scheduler or a loop. Each of its steps is one commit under a name of the tick,
    so a tick that died is called again under its name and goes on where it ended. A batch's requests are committed before
    they are sent and marked as sent afterwards: if a run dies in between, the same batch is sent again under the same id,
    and never do two batches hold one request. An answer counts only for the batch that its request is in now, so one that
    comes after its batch expired changes nothing.
    """

    def __init__(self, store: RunStore, service: Service, size: int = SIZE, retries: int = RETRIES, pause: int = PAUSE_SECONDS, max_age: int = MAX_AGE_SECONDS, buckets: int = 1024):
        self.store, self.service, self.size, self.retries, self.pause, self.max_age, self.buckets = store, service, size, retries, pause, max_age, buckets

    def requests(self, snapshot: Snapshot | None = None, texts: Sequence[str] = ("prompt", "answer")) -> DataFrame:
        """All requests with their state and these of their texts."""
        snapshot = snapshot or self.store.snapshot()
        rows = self.store.read("requests", snapshot)
        for text in texts:
            known = self.store.read(f"{text}s", snapshot) if f"{text}s" in snapshot.tables else self.store.spark.createDataFrame([], f"request_id string, {text} string")
            rows = rows.join(known, "request_id", "left")
        return rows

    def enqueue(self, run: str, prompts: DataFrame, now: datetime) -> Snapshot:
        """Add ``request_id`` and ``prompt``. One that is there stays as it is, nulls as ids are left out, and of several prompts of an id the smallest counts; a null prompt is canceled."""
        if (done := self.store.find(run)) is not None:
            return done
        base = self.store.snapshot()
        new = prompts.where("request_id IS NOT NULL").groupBy("request_id").agg(F.min("prompt").alias("prompt"))
        if "requests" in base.tables:
            new = new.join(self.store.matching(base, "requests", new).select("request_id"), "request_id", "left_anti")
        state = F.when(F.col("prompt").isNull(), "canceled").otherwise("waiting")
        none = lambda kind: F.lit(None).cast(kind)
        rows = new.select("request_id", "prompt", state.alias("state"), F.lit(0).alias("attempts"), F.lit(now).alias("due"), none("string").alias("batch_id"), none("timestamp").alias("sent"))
        return self._commit(base, run, rows, "prompt")

    def tick(self, name: str, now: datetime) -> Snapshot:
        """Take results, expire and put back what failed, deal what is due into batches, send them."""
        for step in (self._take, self._deal, self._send):
            run = f"{name}/{step.__name__[1:]}"
            if self.store.find(run) is None:
                base = self.store.snapshot()
                self._commit(base, run, step(base, name, now), "answer")
        return self.store.snapshot()

    def _commit(self, base: Snapshot, run: str, rows: DataFrame, text: str) -> Snapshot:
        """Rows as they are now, and where they have it and it isn't null, their new ``text``."""
        rows, tables = materialise(rows, "requests"), {}
        upsert = lambda name, new: self.store.upsert(base, name, new, ["request_id"], buckets=self.buckets)
        if text in rows.columns:
            tables[f"{text}s"] = upsert(f"{text}s", rows.select("request_id", text).where(F.col(text).isNotNull()))
        return self.store.commit(base, run, tables | {"requests": upsert("requests", rows.drop(text))})

    def _take(self, base: Snapshot, name: str, now: datetime) -> DataFrame:
        requests = self.requests(base, ())
        out = requests.where("state = 'processing' AND sent IS NOT NULL").select("request_id", "batch_id", "attempts", "sent")
        batches = out.select("batch_id").distinct()
        # A result that comes twice counts once; one that failed counts only if none succeeded.
        ended = requests.sparkSession.createDataFrame([], _RESULT) if batches.isEmpty() else self.service.results(batches)
        got = ended.groupBy("batch_id", "request_id").agg(F.max(F.struct("ok", "answer")).alias("r"))
        met = out.join(got, ["batch_id", "request_id"], "left")
        ok, late = F.coalesce(F.col("r.ok"), F.lit(False)), F.col("sent") <= F.lit(now) - F.make_interval(secs=F.lit(self.max_age))
        last = F.col("attempts") + 1 > self.retries
        state = F.when(ok, "succeeded").when(~last, "waiting").when(F.col("r").isNull(), "expired").otherwise("errored")
        return met.where(F.col("r").isNotNull() | late).select(
            "request_id", state.alias("state"), (F.col("attempts") + 1).alias("attempts"), self._after(now, F.col("attempts")).alias("due"),
            F.when(ok, F.col("batch_id")).alias("batch_id"), F.when(ok, F.col("sent")).alias("sent"), F.when(ok, F.col("r.answer")).alias("answer"),
        )

    def _after(self, now: datetime, attempts: Column) -> Column:
        return F.lit(now) + F.make_interval(secs=(F.lit(self.pause) * F.pow(F.lit(2.0), attempts)).cast("decimal(18,6)"))

    def _deal(self, base: Snapshot, name: str, now: datetime) -> DataFrame:
        due = self.requests(base, ()).where((F.col("state") == "waiting") & (F.col("due") <= F.lit(now))).select("request_id")
        parts = max(1, -(-due.count() // (self.size * DEALT)))
        part = due.withColumn("part", F.pmod(F.xxhash64("request_id"), F.lit(parts)))
        chunk = F.floor((F.row_number().over(W.partitionBy("part").orderBy("request_id")) - 1) / F.lit(self.size))
        return part.select("request_id", F.lit("processing").alias("state"), F.concat_ws("-", F.lit(name), "part", chunk).alias("batch_id"))

    def _send(self, base: Snapshot, name: str, now: datetime) -> DataFrame:
        new = self.requests(base, ()).where("state = 'processing' AND sent IS NULL").select("batch_id", "request_id")
        if not new.isEmpty():
            self.service.submit(new.join(self.store.matching(base, "prompts", new), "request_id"))
        return new.select("request_id", F.lit(now).cast("timestamp").alias("sent"))
