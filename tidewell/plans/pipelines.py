"""Whole runs: ingest, extraction, and the second phase, as one DataFrame plan each."""

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsonx
from ..functions.text import non_blank
from ..operators import dedup, entities, models, novelty, runs, signals
from ..sources import queues, snapshots, store
from ..tables import materialise

RELEVANT = 4


def triage(articles: DataFrame, model: models.TextModel = models.offline_model) -> DataFrame:
    """``articles`` with ``triage`` (a valid answer or null) and ``passes``: relevant enough, or without a valid answer."""
    prompt = F.concat(F.lit("Title: "), F.coalesce("title_en", F.lit("")), F.lit("\n"), F.coalesce("body_en", F.lit("")))
    asked = models.ask(articles.withColumn("prompt", prompt), model).withColumn("triage", jsonx.valid_triage(F.col("answer"))).drop("prompt", "answer")
    return asked.withColumn("passes", F.coalesce(jsonx.whole_number(F.col("triage"), "relevance_score") >= RELEVANT, F.lit(True)))


def extraction_outcomes(articles: DataFrame, model: models.TextModel = models.offline_model) -> DataFrame:
    """Each article with ``outcome`` (extracted, triage_only, error) and ``result``, its JSON.

    The cheap question comes first; only what passes goes to the second one.
    """
    first = materialise(triage(articles, model), "triaged")
    prompt = F.when(F.col("passes"), F.concat(F.lit("Extract. Title: "), F.coalesce("title_en", F.lit("")), F.lit("\n"), F.coalesce("body_en", F.lit(""))))
    asked = models.ask(first.withColumn("prompt", prompt), model).withColumn("extraction", jsonx.valid_extraction(F.col("answer"))).drop("prompt", "answer")
    outcome = F.when(~F.col("passes"), "triage_only").when(F.col("extraction").isNotNull(), "extracted").otherwise("error")
    return asked.withColumns({"outcome": outcome, "result": F.when(F.col("passes"), F.col("extraction")).otherwise(F.col("triage"))}).drop("triage", "extraction", "passes")


EXTRACTED = "array<struct<feature_name: string, category: string, description: string, supplier: string, is_new: boolean>>"


def article_update(outcomes: DataFrame) -> DataFrame:
    """What is written back of each outcome that isn't an error.

    An article that didn't get beyond triage has no names, features or signal: those columns are null here, with
    ``triage_only`` set, and ``write_back`` leaves what is stored of them.
    """
    text = lambda key: F.get_json_object("result", f"$.{key}")
    full = F.col("outcome") == "extracted"
    listed = lambda key, kind: F.when(full, F.coalesce(F.from_json(text(key), kind), F.from_json(F.lit("[]"), kind))).alias(key)
    return outcomes.where("outcome <> 'error'").select(
        "id", text("headline").alias("title_en"), jsonx.whole_number(F.col("result"), "relevance_score").cast("int").alias("relevance_score"), text("content_type").alias("content_type"),
        listed("brands_mentioned", "array<string>"), listed("vehicles_mentioned", "array<string>"), listed("features_extracted", EXTRACTED), F.when(full, text("competitive_signal")).alias("competitive_signal"), (~full).alias("triage_only"),
    )


def write_back(articles: DataFrame, updates: DataFrame) -> DataFrame:
    """``articles`` after ``article_update``; the error of a former run goes."""
    alone = ("brands_mentioned", "vehicles_mentioned", "features_extracted", "competitive_signal")
    short = updates.where("triage_only").drop(*alone)
    return store.processed(store.processed(articles, updates.where("NOT triage_only")), short)


def extraction_run(articles: DataFrame, model: models.TextModel = models.offline_model, limit: int = queues.QUEUE) -> tuple[DataFrame, DataFrame]:
    """The table after a run over the queue, and its summary. Errors stay queued with a message."""
    outcomes = materialise(extraction_outcomes(queues.unprocessed(articles, limit), model), "outcomes")
    done = write_back(articles, article_update(outcomes))
    errors = outcomes.where("outcome = 'error'").select("id", F.lit("no valid answer").alias("error"))
    return store.failed(done, errors), run_summary(outcomes)


def run_summary(outcomes: DataFrame) -> DataFrame:
    return outcomes.agg(
        F.count("*").alias("total"), F.count_if(F.col("outcome") == "extracted").alias("succeeded"), F.count_if(F.col("outcome") == "error").alias("failed"), F.count_if(F.col("outcome") == "triage_only").alias("triage_skipped"),
    )


def narratives(candidates: DataFrame, articles: DataFrame, model: models.TextModel = models.offline_model) -> DataFrame:
    """Signals with title, implications and impact from a valid answer; candidates without one give none."""
    asked = models.ask(signals.narrative_prompts(candidates, articles), model).withColumn("narrative", jsonx.valid_narrative(F.col("answer"))).where("narrative IS NOT NULL")
    text = lambda key: F.get_json_object("narrative", f"$.{key}")
    return asked.select(
        F.concat_ws("/", "signal_type", "article_id", F.md5("trigger_data")).alias("id"), "signal_type", text("title").alias("title"), "brands_mentioned", "features_mentioned", F.array("article_id").alias("source_article_ids"),
        text("implications_for_western_oems").alias("implications_for_western_oems"), text("competitive_impact_score").try_cast("int").alias("competitive_impact_score"),
    )


@dataclass
class Phase2:
    articles: DataFrame
    brands: DataFrame
    vehicles: DataFrame
    features: DataFrame
    promoted: DataFrame
    signals: DataFrame
    article_novelty: DataFrame
    signal_novelty: DataFrame


def second_phase(
    articles: DataFrame, features: DataFrame, aliases: DataFrame, meta: DataFrame, old_signals: DataFrame, as_of: Column, model: models.TextModel = models.offline_model, limit: int | None = queues.PHASE2,
    stored_brands: DataFrame | None = None, answers: DataFrame | None = None, newest: datetime | None = None, groups_in_novelty: bool = True,
) -> Phase2:
    """Entities, duplicates, signals and novelty of the queue's articles.

    Duplicates are looked for in the batch and the recent articles, and only groups that touch the batch are marked. The
    batch is flagged as done in ``articles``; a run that fails before it is written leaves all as it was. ``answers`` are
    those of a ``resolver_run``. Signals count as recent for 14 days; a new signal is compared with the old ones and with
    the others of its run. Without ``groups_in_novelty`` an article of the batch is compared with its own duplicates too,
    unless an earlier run grouped them.
    """
    batch = materialise(queues.phase2_queue(articles, limit), "batch")
    newest = newest or articles.agg(F.max("scrape_date")).first()[0]
    corpus = queues.corpus_without_batch(queues.recent_processed(articles, newest), batch) if newest is not None else batch
    members = materialise(dedup.group_members(corpus, dedup.scored_pairs(corpus)), "members")
    touched = members.join(batch.select("id"), "id", "left_semi").select("component").distinct()
    own = materialise(members.join(touched, "component", "left_semi"), "groups")
    marked = dedup.mark_duplicates(articles, own)
    fresh = materialise(dedup.mark_duplicates(batch, own), "marked-batch")
    known = store.recent_signals(old_signals, as_of, novelty.SIGNAL_DAYS) if "created_date" in old_signals.columns else old_signals
    candidates = signals.signal_candidates(fresh, features)
    found = materialise(store.new_signals(narratives(candidates, fresh, model), as_of), "signals")
    recent = queues.recent_processed(marked, newest, 24 * novelty.ARTICLE_DAYS) if newest is not None else marked
    promoted = entities.promote_entities(batch, aliases, meta, stored_brands, answers)
    return Phase2(
        store.phase2_done(marked, batch), promoted.brands, promoted.vehicles, promoted.features, promoted.counts, found,
        novelty.article_novelty(fresh if groups_in_novelty else batch, recent), novelty.signal_novelty(found, known.unionByName(found, allowMissingColumns=True)),
    )


def commit_phase2(done: Phase2, before: DataFrame, into: snapshots.RunStore, base: snapshots.Snapshot, run: str, as_of: Column, buckets: int = snapshots.BUCKETS) -> snapshots.Snapshot:
    """Write what a run changed and make all of it count at once; a run that counts already isn't written again.

    Entities are merged by their keys and signals by id; of the articles (``before`` the run) the changed ones are written.
    A run that dies on the way leaves the snapshot as it was, the queue too; done again under its name it counts once.
    """
    if (counts := into.find(run)) is not None:
        return counts
    write = lambda name, rows, *key, **rules: into.upsert(base, name, rows, key, buckets=buckets, **rules)
    made = {
        "brands": write("brands", done.brands, "name_en", as_of=as_of),
        "vehicles": write("vehicles", done.vehicles, "brand_id", "model_name_en", as_of=as_of),
        "features": write("features", done.features, *entities.FEATURE_KEY, create_only=["first_seen_date"], keep_known=entities.FEATURE_LINK, as_of=as_of),
        "signals": write("signals", done.signals, "id", create_only=["created_date"]),
        "articles": write("articles", snapshots.changed_rows(before, done.articles), "id"),
    }
    return into.commit(base, run, made)


def ingest(listings: DataFrame, scraped: DataFrame, articles: DataFrame, per_source: int = queues.PER_SOURCE) -> DataFrame:
    """New articles of a run: listings not stored yet, up to the cap of each source, with what their pages gave."""
    wanted = queues.new_listings(listings, articles, per_source)
    return store.new_articles(scraped.join(wanted.select("source_url"), "source_url", "left_semi").where(non_blank(F.col("title")).isNotNull()))


@dataclass
class Ingested:
    articles: DataFrame
    health: DataFrame
    totals: DataFrame


def ingest_run(listings: DataFrame, scraped: DataFrame, articles: DataFrame, requests: DataFrame, sources: DataFrame, as_of: Column, per_source: int = queues.PER_SOURCE) -> Ingested:
    """A run over all sources: the articles to append, a health row for each source, and the run's totals.

    ``requests`` has a row for each page that was asked for: ``source_name``, ``ts``, ``url``, and ``message`` if that
    failed. A source without requests never started and gets zeros.
    """
    fresh = materialise(ingest(listings, scraped, articles, per_source), "ingested")
    asked = requests.select("source_name", "ts", "url", "message", F.lit("request").alias("kind"))
    failed = asked.where("message IS NOT NULL").withColumn("kind", F.lit("error"))
    taken = fresh.select("source_name", F.col("scrape_date").alias("ts"), F.col("source_url").alias("url"), F.lit(None).cast("string").alias("message"), F.lit("ingested").alias("kind"))
    health = runs.health_rows(asked.unionByName(failed).unionByName(taken), sources, as_of)
    return Ingested(fresh, health, runs.run_totals(health))
