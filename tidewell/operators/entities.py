"""Entities: brands by alias, vehicles by the longest brand prefix, features by the first resolved brand."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.jsonx import valid_resolution
from ..functions.text import non_blank, strip
from ..tables import materialise
from .models import TextModel, ask, offline_model

# Names that extraction returns as brands and that aren't; words a brand has at most before a model.
NOT_BRANDS = ("iQIYI", "爱奇艺", "Honor", "荣耀", "Flyme", "元镜", "Yuan Mirror", "国家大剧院", "National Centre for the Performing Arts")
PREFIX_WORDS = 3
#: Unknown names of a run that may go to the text model.
MODEL_CALLS = 20


def name_key(name: Column) -> Column:
    return F.lower(strip(name))


def is_not_a_brand(name: Column) -> Column:
    return F.lower(strip(name)).isin([n.lower() for n in NOT_BRANDS])


def alias_table(aliases: DataFrame) -> DataFrame:
    """``alias`` (a key) and ``canonical``; of aliases that differ in case the first by name counts."""
    return aliases.groupBy(F.lower("alias").alias("alias")).agg(F.min("canonical").alias("canonical"))


def mentioned_brands(articles: DataFrame) -> DataFrame:
    """One row for each brand an article names and its place in the list, without those that are no brands."""
    rows = articles.select("id", "ord", F.posexplode("brands_mentioned").alias("pos", "name"))
    return rows.where(non_blank(F.col("name")).isNotNull() & ~is_not_a_brand(F.col("name")))


def resolve_brands(named: DataFrame, aliases: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """``named`` with ``canonical``: by alias, else by what a text model answered for the key; null if neither knows it."""
    out = named.withColumn("key", name_key(F.col("name"))).join(alias_table(aliases).withColumnRenamed("alias", "key"), "key", "left")
    if answers is not None:
        known = answers.where("name_en IS NOT NULL").groupBy("key").agg(F.min("name_en").alias("answered"))
        out = out.join(known, "key", "left").withColumn("canonical", F.coalesce("canonical", "answered")).drop("answered")
    return out


def names_for_the_model(named: DataFrame, aliases: DataFrame, calls: int = MODEL_CALLS) -> DataFrame:
    """The first ``calls`` distinct names that no alias knows, in order of appearance: ``key``, ``turn``."""
    unknown = resolve_brands(named, aliases).where("canonical IS NULL").groupBy("key").agg(F.min(F.struct("ord", "pos")).alias("first"))
    first = unknown.orderBy("first", "key").limit(calls)  # a top-k: each partition keeps at most that many
    return first.withColumn("turn", F.row_number().over(W.orderBy("first", "key"))).select("key", "turn")


def promote_brands(articles: DataFrame, aliases: DataFrame, meta: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """Each resolved brand once, with its metadata where the dictionary has it: what a run upserts."""
    resolved = resolve_brands(mentioned_brands(articles), aliases, answers).where("canonical IS NOT NULL")
    return resolved.groupBy(F.col("canonical").alias("name_en")).agg(F.countDistinct("id").alias("n_articles")).join(meta, "name_en", "left")


def split_vehicles(named: DataFrame, aliases: DataFrame) -> DataFrame:
    """``named`` (with ``name``) with ``brand`` and ``model`` by the longest prefix of whole words that is an alias.

    A word at least must remain for the model. Names without such a prefix are left out. Expects ``row`` to tell rows apart.
    """
    words = F.split(strip(F.col("name")), r"[\s　]+")
    longest = F.least(F.size("words") - 1, F.lit(PREFIX_WORDS))
    tries = named.withColumn("words", words).where(F.size("words") >= 2).withColumn("n", F.explode(F.sequence(F.lit(1), longest)))
    tries = tries.withColumn("alias", F.lower(F.array_join(F.slice("words", F.lit(1), F.col("n")), " ")))
    met = tries.join(alias_table(aliases), "alias")
    best = met.groupBy("row").agg(F.max_by(F.struct("canonical", F.array_join(F.slice("words", F.col("n") + 1, F.size("words")), " ").alias("model")), "n").alias("best"))
    return named.join(best, "row").select(named["*"], F.col("best.canonical").alias("brand"), F.col("best.model").alias("model"))


def entity_id(*key: Column) -> Column:
    """The id of an entity is made from its key, so a run done again writes the same ids."""
    return F.md5(F.concat_ws("/", *key))


def with_brand_ids(promoted: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """``promoted`` brands with ``brand_id``: the stored one, or one made from the name."""
    if stored is None:
        return promoted.withColumn("brand_id", entity_id(F.col("name_en")))
    known = stored.groupBy("name_en").agg(F.min("brand_id").alias("known_id"))
    return promoted.join(known, "name_en", "left").withColumn("brand_id", F.coalesce("known_id", entity_id(F.col("name_en")))).drop("known_id")


def mentioned_vehicles(articles: DataFrame, aliases: DataFrame, brands: DataFrame) -> DataFrame:
    """One row for each vehicle that an article names: ``id``, ``pos``, ``name``, ``brand_id``, ``brand_name_en``, ``model_name_en``, ``vehicle_id``.

    The brand is the longest prefix that is an alias; its id comes from ``brands`` (``name_en``, ``brand_id``: those of the
    run and those that are stored). Vehicles without such a brand are left out.
    """
    rows = articles.select("id", F.posexplode(F.array_distinct("vehicles_mentioned")).alias("pos", "name")).where("name IS NOT NULL").withColumn("row", F.struct("id", "pos"))
    ids = brands.groupBy(F.col("name_en").alias("brand")).agg(F.min("brand_id").alias("brand_id"))
    met = split_vehicles(rows, aliases).join(ids, "brand")
    return met.select("id", "pos", "name", "brand_id", F.col("brand").alias("brand_name_en"), F.col("model").alias("model_name_en"), entity_id(F.col("brand_id"), F.col("model")).alias("vehicle_id"))


def promote_vehicles(articles: DataFrame, aliases: DataFrame, brands: DataFrame) -> DataFrame:
    """Each vehicle of a known brand once: what a run upserts on brand and model."""
    named = mentioned_vehicles(articles, aliases, brands)
    return named.groupBy("brand_id", "model_name_en").agg(F.min("brand_name_en").alias("brand_name_en"), F.min("vehicle_id").alias("vehicle_id"), F.countDistinct("id").alias("n_articles"))


def promote_features(articles: DataFrame, aliases: DataFrame, answers: DataFrame | None = None, brands: DataFrame | None = None) -> DataFrame:
    """New features of each article, linked to its first resolved brand; articles without one give none.

    A brand that only the text model knew keeps the name the article uses. With ``brands`` (``name_en``, ``brand_id``) the
    features have ``brand_id`` and, of the first vehicle that resolves, ``vehicle_id`` and ``vehicle_model_name``.
    """
    resolved = resolve_brands(mentioned_brands(articles), aliases, answers).where("canonical IS NOT NULL")
    by_alias = resolved.join(alias_table(aliases).select(F.col("alias").alias("key"), F.lit(True).alias("listed")), "key", "left")
    shown = F.when(F.col("listed"), F.col("canonical")).otherwise(F.col("name"))
    first = by_alias.groupBy("id").agg(F.min_by(F.struct(shown.alias("shown"), "canonical"), "pos").alias("b")).select("id", F.col("b.shown").alias("brand_name_en"), F.col("b.canonical").alias("canonical"))
    fresh = articles.select("id", "scrape_date", F.posexplode(F.filter("features_extracted", lambda f: F.coalesce(f["is_new"], F.lit(False)))).alias("pos", "f")).join(first, "id")
    linked: list[Column] = []
    if brands is not None:
        ids = brands.groupBy(F.col("name_en").alias("canonical")).agg(F.min("brand_id").alias("brand_id"))
        vehicle = mentioned_vehicles(articles, aliases, brands).groupBy("id").agg(F.min_by(F.struct("vehicle_id", "model_name_en"), "pos").alias("v"))
        fresh = fresh.join(ids, "canonical", "left").join(vehicle, "id", "left")
        linked = [F.col("brand_id"), F.col("v.vehicle_id").alias("vehicle_id"), F.col("v.model_name_en").alias("vehicle_model_name")]
    return fresh.select(
        F.col("id").alias("article_id"), "brand_name_en", F.col("f.feature_name").alias("feature_name_en"), F.col("f.category").alias("category"), F.coalesce("f.description", F.lit("")).alias("description"),
        F.col("f.supplier").alias("supplier"), F.lit("new").alias("launch_type"), F.col("scrape_date").alias("first_seen_date"), "pos", *linked,
    )


#: What identifies a feature, and what an article that lacks it leaves as it is stored.
FEATURE_KEY, FEATURE_LINK = ("brand_id", "feature_name_en", "category"), ("vehicle_id", "vehicle_model_name")


def merge_features(features: DataFrame) -> DataFrame:
    """A run's features once for each brand, name and category, as if its articles were written one after another.

    The queue has the newest article first, so the oldest is written last and its values count (of equal dates the larger
    id, then the later feature of the article); the vehicle is that of the last article that has one. ``first_seen_date``
    is the earliest.
    """
    order = F.struct(F.col("first_seen_date").isNull(), -F.unix_micros("first_seen_date"), "article_id", "pos")
    values = [c for c in features.columns if c not in (*FEATURE_KEY, *FEATURE_LINK, "first_seen_date", "pos")]
    linked = F.when(F.col("vehicle_id").isNotNull(), order)
    one = features.groupBy(*FEATURE_KEY).agg(F.max_by(F.struct(*values), order).alias("f"), F.max_by(F.struct(*FEATURE_LINK), linked).alias("v"), F.min("first_seen_date").alias("first_seen_date"))
    return one.select(*FEATURE_KEY, *(F.col(f"f.{c}").alias(c) for c in values), *(F.col(f"v.{c}").alias(c) for c in FEATURE_LINK), "first_seen_date")


@dataclass
class Promoted:
    brands: DataFrame
    vehicles: DataFrame
    features: DataFrame
    counts: DataFrame


def promote_entities(articles: DataFrame, aliases: DataFrame, meta: DataFrame, stored: DataFrame | None = None, answers: DataFrame | None = None) -> Promoted:
    """Brands, then vehicles, then features of a run, as rows to upsert (once for each key), and each article's counts.

    An article's counts are of distinct names of brands and of vehicles that resolve, and of new features if a brand does.
    ``merge_features`` says which of several features with one key counts.
    """
    brands = materialise(with_brand_ids(promote_brands(articles, aliases, meta, answers), stored), "brands")
    known = brands.select("name_en", "brand_id") if stored is None else brands.select("name_en", "brand_id").unionByName(stored.select("name_en", "brand_id"))
    features = materialise(promote_features(articles, aliases, answers, known), "features")
    named = resolve_brands(mentioned_brands(articles), aliases, answers).where("canonical IS NOT NULL").groupBy("id").agg(F.countDistinct("name").alias("brands"))
    moved = mentioned_vehicles(articles, aliases, known).groupBy("id").agg(F.countDistinct("name").alias("vehicles"))
    fresh = features.groupBy(F.col("article_id").alias("id")).agg(F.count("*").alias("features"))
    counts = articles.select("id").join(named, "id", "left").join(moved, "id", "left").join(fresh, "id", "left")
    return Promoted(brands, promote_vehicles(articles, aliases, known), merge_features(features), counts.select("id", *(F.coalesce(n, F.lit(0)).alias(f"{n}_promoted") for n in ("brands", "vehicles", "features"))))


def resolver_run(articles: DataFrame, aliases: DataFrame, memo: DataFrame | None = None, model: TextModel = offline_model, calls: int = MODEL_CALLS) -> DataFrame:
    """``memo`` (``key``, ``name_en``) after a run: what the text model said of the names that neither alias nor memo knows.

    The first ``calls`` names in order of appearance are asked for, each once; a name without a valid answer is kept with a
    null, so that it costs no second call. The rows with a ``name_en`` are the ``answers`` that promotion takes.
    """
    named = mentioned_brands(articles)
    if memo is not None:
        named = named.withColumn("key", name_key(F.col("name"))).join(memo.select("key"), "key", "left_anti").drop("key")
    wanted = names_for_the_model(named, aliases, calls).withColumn("prompt", F.concat(F.lit("Which car brand is this? Answer with name_en. Name: "), "key"))
    asked = ask(wanted, model).withColumn("name_en", F.get_json_object(valid_resolution(F.col("answer")), "$.name_en")).select("key", "name_en")
    return asked if memo is None else memo.select("key", "name_en").unionByName(asked)
