"""Market signals: six rules over articles and their extracted features."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sets import lower_set, present
from ..functions.text import keywords_in, non_blank
from ..tables import materialise

# Signal types, and the keywords that the two keyword rules look for.
SIGNAL_TYPES = ("new_feature_launch", "feature_trickle_down", "ai_integration", "ota_deployment", "partnership_change", "chip_hardware_announcement")
AI_KEYWORDS = (
    "llm", "large language model", "gpt", "chatgpt", "ernie", "wenxin", "tongyi",
    "qianwen", "baidu ai", "sensetime", "deepseek", "large model", "foundation model", "generative ai",
)
CHIP_KEYWORDS = (
    "tops", "chip", "soc", "processor", "compute power", "computing power", "nvidia", "orin",
    "qualcomm", "snapdragon", "horizon robotics", "journey", "black sesame", "huawei ascend", "mdc",
)
EXCERPT = 2000


def _candidate(kind: str, features: Column, trigger: Column) -> Column:
    """A candidate of an article as a struct; ``trigger``: what set the rule off, as JSON."""
    data = F.to_json(trigger, {"ignoreNullFields": "false"})
    return F.struct(F.lit(kind).alias("signal_type"), features.cast("array<string>").alias("features_mentioned"), data.alias("trigger_data"))


def _rows(articles: DataFrame, candidates: Column) -> DataFrame:
    """The candidates of each article (an array) as rows."""
    return articles.select(F.col("id").alias("article_id"), present(F.col("brands_mentioned")).alias("brands_mentioned"), F.inline(candidates)).select("signal_type", "article_id", "brands_mentioned", "features_mentioned", "trigger_data")


def _new(f: Column) -> Column:
    return F.coalesce(f["is_new"], F.lit(False))


def _exploded(articles: DataFrame, condition) -> DataFrame:
    """One row for each feature that meets the condition."""
    return articles.withColumn("f", F.explode(F.filter("features_extracted", condition)))


def _of_features(condition: Callable[[Column], Column], build: Callable[[Column], Column]) -> Column:
    """A candidate for each feature that meets the condition; null for an article without features."""
    return F.transform(F.filter("features_extracted", condition), build)


def _name(f: Column) -> Column:
    return F.coalesce(f["feature_name"], F.lit(""))


def _launches() -> Column:
    trigger = lambda f: F.struct(f["feature_name"].alias("feature_name"), f["category"].alias("category"), f["description"].alias("description"))
    return _of_features(_new, lambda f: _candidate(SIGNAL_TYPES[0], F.array(_name(f)), trigger(f)))


def _integrations() -> Column:
    """A new assistant feature, or without one AI keywords in the title or body of news and opinion; a candidate at most.

    Either way the candidate mentions all assistant features of the article, new or not.
    """
    assistants = F.filter("features_extracted", lambda f: f["category"] == "ai_assistant")
    text = F.concat_ws(" ", F.coalesce("title_en", F.lit("")), F.coalesce("body_en", F.lit("")))
    none = F.array().cast("array<string>")

    def of(parts: Column) -> Column:
        fresh, words = F.filter(parts["assistants"], _new), parts["words"]
        by_feature, by_word = F.coalesce(F.size(fresh) > 0, F.lit(False)), F.coalesce(F.size(words) > 0, F.lit(False))
        trigger = F.struct(
            F.when(by_feature, "new_ai_feature").otherwise("ai_keyword_match").alias("trigger_reason"), F.when(by_feature, none).otherwise(words).alias("matched_keywords"),
            F.try_element_at(fresh, F.lit(1))["feature_name"].alias("feature_name"),
        )
        return F.when(by_feature | by_word, _candidate(SIGNAL_TYPES[2], F.coalesce(F.transform(parts["assistants"], _name), none), trigger))

    parts = F.array(F.struct(assistants.alias("assistants"), F.when(F.col("content_type").isin("news", "opinion"), keywords_in(text, AI_KEYWORDS)).alias("words")))
    return F.filter(F.transform(parts, of), lambda c: c.isNotNull())


def _deployments() -> Column:
    trigger = lambda f: F.struct(f["feature_name"].alias("feature_name"), f["description"].alias("description"))
    return _of_features(lambda f: _new(f) & (f["category"] == "ota"), lambda f: _candidate(SIGNAL_TYPES[3], F.array(_name(f)), trigger(f)))


def _partnerships() -> Column:
    """Two brands or more, repeated ones included, and a competitive signal."""
    one = _candidate(SIGNAL_TYPES[4], F.array(), F.struct("competitive_signal", F.size("brands_mentioned").alias("brand_count")))
    return F.when((F.size(present(F.col("brands_mentioned"))) >= 2) & non_blank(F.col("competitive_signal")).isNotNull(), F.array(one))


def _chips() -> Column:
    """Driver-assistance features, new or not, whose description has a chip keyword."""
    words = lambda f: F.coalesce(keywords_in(f["description"], CHIP_KEYWORDS), F.array().cast("array<string>"))
    trigger = lambda f: F.struct(f["feature_name"].alias("feature_name"), words(f).alias("matched_keywords"), f["description"].alias("description"))
    return _of_features(lambda f: (f["category"] == "adas") & (F.size(words(f)) > 0), lambda f: _candidate(SIGNAL_TYPES[5], F.array(_name(f)), trigger(f)))


def new_feature_launches(articles: DataFrame) -> DataFrame:
    return _rows(articles, _launches())


def ai_integrations(articles: DataFrame) -> DataFrame:
    return _rows(articles, _integrations())


def ota_deployments(articles: DataFrame) -> DataFrame:
    return _rows(articles, _deployments())


def partnership_changes(articles: DataFrame) -> DataFrame:
    return _rows(articles, _partnerships())


def chip_announcements(articles: DataFrame) -> DataFrame:
    return _rows(articles, _chips())


def trickle_down_matches(articles: DataFrame, features: DataFrame) -> DataFrame:
    """New features of articles against features in the same category whose brand the article doesn't name."""
    rows = _exploded(articles, lambda f: _new(f) & (F.coalesce(f["category"], F.lit("")) != "")).withColumn("named", lower_set(F.col("brands_mentioned")))
    known = features.where(non_blank(F.col("brand_name_en")).isNotNull()).select(F.col("category").alias("at"), F.col("brand_name_en").alias("existing_brand"), F.col("feature_name_en").alias("existing_feature"))
    return rows.join(known, F.col("f.category") == F.col("at")).where(~F.array_contains("named", F.lower("existing_brand")))


def trickle_down_totals(articles: DataFrame, features: DataFrame) -> DataFrame:
    """``trickle_down_matches`` counted: ``id``, ``existing_brand``, ``existing_feature`` and ``n``, how often they meet.

    Both sides are counted before they meet, so there are as many matches as rows of the result, if an article's new
    features are in one category. Articles are dealt by id first; where the counted features are few enough to be sent to
    all tasks, the matches are added up where they are made and never shuffled.
    """
    known = features.where(non_blank(F.col("brand_name_en")).isNotNull()).groupBy(F.col("category").alias("at"), F.col("brand_name_en").alias("existing_brand"), F.col("feature_name_en").alias("existing_feature")).agg(F.count("*").alias("theirs"))
    known = materialise(known, "known-features")  # so the planner knows its size
    new = _exploded(articles.select("id", "brands_mentioned", "features_extracted"), lambda f: _new(f) & (F.coalesce(f["category"], F.lit("")) != ""))
    slim = new.select("id", lower_set(F.col("brands_mentioned")).alias("named"), F.col("f.category").alias("category"))
    dealt = slim.repartition(int(articles.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id")  # a number of its own: matches are many more than what is dealt
    mine = dealt.groupBy("id", "named", "category").agg(F.count("*").alias("own"))
    met = mine.join(known, F.col("category") == F.col("at")).where(~F.array_contains("named", F.lower("existing_brand")))
    return met.groupBy("id", "existing_brand", "existing_feature").agg(F.sum(F.col("own") * F.col("theirs")).alias("n"))


def trickle_downs(articles: DataFrame, features: DataFrame) -> DataFrame:
    """A new feature in a category where a brand that the article doesn't name has one already; a row for each of those."""
    f = F.col("f")
    trigger = F.struct(f["feature_name"].alias("new_feature_name"), f["category"].alias("new_feature_category"), F.col("existing_feature").alias("existing_feature_name"), "existing_brand")
    return _rows(trickle_down_matches(articles, features), F.array(_candidate(SIGNAL_TYPES[1], F.array(_name(f)), trigger)))


def trickle_down_counts(articles: DataFrame, features: DataFrame) -> DataFrame:
    """How many such rows each article gives, from how many brands, without making them: features meet as counts by brand."""
    named = features.where(non_blank(F.col("brand_name_en")).isNotNull())
    by_brand = named.groupBy("category", "brand_name_en").agg(F.count("*").alias("n"))
    rows = _exploded(articles.select("id", "brands_mentioned", "features_extracted"), lambda f: _new(f) & (F.coalesce(f["category"], F.lit("")) != ""))
    slim = rows.select("id", lower_set(F.col("brands_mentioned")).alias("named"), F.col("f.category").alias("category"))
    met = slim.join(by_brand, "category").where(~F.array_contains("named", F.lower("brand_name_en")))
    return met.groupBy(F.col("id").alias("article_id")).agg(F.sum("n").alias("n_matches"), F.countDistinct("brand_name_en").alias("n_brands"), F.min("brand_name_en").alias("first_brand"))


def signal_candidates(articles: DataFrame, features: DataFrame | None) -> DataFrame:
    """All candidates of articles that aren't duplicates; without known features the trickle-down rule rests."""
    own = articles.where(~F.coalesce("is_duplicate", F.lit(False)))
    none = F.array().cast("array<struct<signal_type:string,features_mentioned:array<string>,trigger_data:string>>")
    rules = (_launches(), _integrations(), _deployments(), _partnerships(), _chips())
    out = _rows(own, F.concat(*(F.coalesce(r, none) for r in rules)))  # one pass over the articles for all five
    return out if features is None else out.unionByName(trickle_downs(own, features))


def signals_by_type(candidates: DataFrame) -> DataFrame:
    """A count for each of the six types, zeros included."""
    kinds = candidates.sparkSession.createDataFrame([(t,) for t in SIGNAL_TYPES], "signal_type string")
    return kinds.join(candidates.groupBy("signal_type").agg(F.count("*").alias("n")), "signal_type", "left").select("signal_type", F.coalesce("n", F.lit(0)).alias("n_signals"))


def signal_counts(articles: DataFrame, features: DataFrame) -> DataFrame:
    """``signals_by_type`` of all six rules, without making the trickle-down rule's rows."""
    own = articles.where(~F.coalesce("is_duplicate", F.lit(False)))
    rows = trickle_down_counts(own, features).agg(F.coalesce(F.sum("n_matches"), F.lit(0)).alias("rows"))
    counted = signals_by_type(signal_candidates(own, None)).join(F.broadcast(rows))  # one row
    return counted.select("signal_type", F.when(F.col("signal_type") == SIGNAL_TYPES[1], F.col("rows")).otherwise(F.col("n_signals")).alias("n_signals"))


def narrative_prompts(candidates: DataFrame, articles: DataFrame) -> DataFrame:
    """Prompt text of each candidate: its data and an excerpt of the article."""
    summary = F.coalesce(non_blank(F.col("body_en")), F.lit(""))
    joined = candidates.join(articles.select(F.col("id").alias("article_id"), "title_en", "body_en"), "article_id", "left")
    return joined.withColumn("prompt", F.concat(F.lit("Signal: "), "signal_type", F.lit("\nData: "), "trigger_data", F.lit("\nTitle: "), F.coalesce("title_en", F.lit("")), F.lit("\n"), F.substring(summary, 1, EXCERPT))).drop("title_en", "body_en")
