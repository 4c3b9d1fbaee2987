"""Novelty: one minus the greatest similarity to anything recent."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.sets import feature_categories, jaccard_of_sets, lower_set, present
from ..functions.text import letters, title_bound, title_similarity
from ..tables import materialise
from .nearest import COMMON as COMMON_TERMS
from .nearest import greatest_alike

# Weights of title, brands, content and type for articles; of type, brands, features and sources for signals.
ARTICLE_TITLE, ARTICLE_BRANDS, ARTICLE_CONTENT, ARTICLE_TYPE = 0.35, 0.25, 0.25, 0.15
SIGNAL_TYPE, SIGNAL_BRANDS, SIGNAL_FEATURES, SIGNAL_SOURCES = 0.3, 0.35, 0.2, 0.15
ARTICLE_DAYS, SIGNAL_DAYS = 7, 14
# The categories that features have.
CATEGORIES = ("adas", "ai_assistant", "infotainment", "connectivity", "ota", "battery_software", "cockpit_ux")
#: Rows of a batch that go to every partition of the recent ones; larger batches are dealt into blocks.
BATCH = 1000


def novelty(greatest: Column) -> Column:
    """From 0 to 1; 1 with nothing to compare."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(1.0) - F.coalesce(greatest, F.lit(0.0))))


def prepare_articles(articles: DataFrame) -> DataFrame:
    content = F.array_union(present(F.col("vehicles_mentioned")), feature_categories(F.col("features_extracted")))
    return articles.select(
        "id", F.col("title_en").alias("title"), lower_set(F.col("brands_mentioned")).alias("brands"), lower_set(content).alias("content"), F.nullif("content_type", F.lit("")).alias("kind"),
        F.lower(F.try_element_at("brands_mentioned", F.lit(1))).alias("primary"), F.nullif("duplicate_group_id", F.lit("")).alias("group_id"),
    )


def _set_similarity() -> tuple[Column, Column, Column]:
    same = (F.col("a.kind") == F.col("b.kind")) & (F.col("a.primary") == F.col("b.primary"))
    return jaccard_of_sets(F.col("a.brands"), F.col("b.brands")), jaccard_of_sets(F.col("a.content"), F.col("b.content")), F.when(F.coalesce(same, F.lit(False)), 1.0).otherwise(0.0)


def _others() -> Column:
    """Not the article itself, nor one of its duplicate group."""
    return ~F.col("a.id").eqNullSafe(F.col("b.id")) & ~F.coalesce(F.col("a.group_id") == F.col("b.group_id"), F.lit(False))


def _who(group: Column, own: Column) -> Column:
    """What an article isn't compared with itself as: its duplicate group, or itself."""
    return F.coalesce(F.concat(F.lit("g"), group), F.concat(F.lit("i"), own), F.lit("n"))


def best_other(rows: DataFrame, key: Sequence[str], score: str, low: str, high: str) -> DataFrame:
    """For each ``key`` the best score, ``who`` has it, and the best that another has: what anyone needs to find the best of the others.

    Rows are groups of identities, given by the smallest and the largest of each group.
    """
    each = rows.select(*key, score, F.explode(F.array_distinct(F.array(low, high))).alias("who")).groupBy(*key, "who").agg(F.max(score).alias("score"))
    turn = F.row_number().over(W.partitionBy(*key).orderBy(F.desc("score"), "who"))
    two = each.withColumn("turn", turn).where("turn <= 2")
    of = lambda n, c: F.max(F.when(F.col("turn") == n, F.col(c)))
    return two.groupBy(*key).agg(of(1, "who").alias("who"), of(1, "score").alias("best"), of(2, "score").alias("second"))


def _by_category(asked: DataFrame, recent: DataFrame) -> DataFrame:
    """``unit`` and ``floor``: for each asked row the most that categories in common alone can give.

    Rows count by their categories and the size of their content ``b`` only, and there are few of such forms: at most one
    for each set of the fixed categories and each size.
    """
    forms = lambda df: df.withColumn("kinds", F.array_sort(F.array_intersect("b", F.array(*(F.lit(c) for c in CATEGORIES))))).where(F.size("kinds") > 0).withColumn("n", F.size("b"))
    mine, theirs = forms(asked), forms(recent).groupBy("kinds", "n").agg(F.min("who").alias("low"), F.max("who").alias("high"))
    sizes = mine.select("kinds", "n").distinct()
    met = sizes.select("kinds", "n", F.explode("kinds").alias("kind")).join(theirs.select(F.col("kinds").alias("other"), F.col("n").alias("m"), "low", "high", F.explode("kinds").alias("kind")), "kind")
    both = F.size(F.array_intersect("kinds", "other"))
    scored = met.withColumn("score", both / (F.col("n") + F.col("m") - both) * F.lit(ARTICLE_CONTENT))
    best = best_other(scored, ["kinds", "n"], "score", "low", "high").withColumnRenamed("who", "of")
    return mine.join(best, ["kinds", "n"]).select("unit", F.when(F.col("of") == F.col("who"), F.col("second")).otherwise(F.col("best")).alias("floor"))


def article_set_novelty(articles: DataFrame, recent: DataFrame, common: int = COMMON_TERMS) -> DataFrame:
    """Novelty of every article by brands, content and type alone.

    Articles with equal sets and type count as one, with the smallest and the largest identity (``nearest``). A pair that
    has only categories in common has what ``_by_category`` gives, so that nothing is met on the few categories that all
    articles share.
    """
    tag = F.when(F.col("kind").isNotNull() & F.col("primary").isNotNull(), F.to_json(F.array("kind", "primary")))
    form = F.md5(F.to_json(F.struct("a", "b", "tag")))

    def prepared(df: DataFrame) -> DataFrame:
        sets = prepare_articles(df).select("id", _who(F.col("group_id"), F.col("id")).alias("who"), F.array_sort("brands").alias("a"), F.array_sort("content").alias("b"), tag.alias("tag"))
        return sets.withColumn("form", form)

    a = materialise(prepared(articles), "article-sets")  # read several times
    b = a if recent is articles else materialise(prepared(recent), "article-sets")
    parts = (("a", ARTICLE_BRANDS), ("b", ARTICLE_CONTENT), ("tag", ARTICLE_TYPE))
    found = greatest_alike(a, b, parts, lambda asked: _by_category(asked, b), CATEGORIES, common)
    return _novelty_of(a, a.select("id", "form", "who").join(found.hint("merge"), ["form", "who"]).select("id", "greatest"))


def _novelty_of(rows: DataFrame, greatest: DataFrame) -> DataFrame:
    best = greatest.groupBy("id").agg(F.max("greatest").alias("greatest"))
    return rows.select("id").join(best.hint("merge"), "id", "left").select("id", novelty(F.col("greatest")).alias("novelty"))


def article_novelty(batch: DataFrame, recent: DataFrame) -> DataFrame:
    """Novelty of a batch against all recent articles, titles included.

    A batch of at most ``BATCH`` rows goes to every partition of the recent articles. A larger one is dealt into blocks of
    that size, and each block meets all recent articles. Titles are compared only where they can still beat the article's
    best similarity without them.
    """
    size = batch.count()
    a, b = (prepare_articles(x).withColumn("letters", letters(F.col("title"))).select(F.struct("*").alias(side)) for x, side in ((batch, "a"), (recent, "b")))
    if size <= BATCH:
        met = b.join(F.broadcast(a), _others())
    else:
        blocks = -(-size // BATCH)
        dealt = a.withColumn("block", F.pmod(F.xxhash64("a.id"), F.lit(blocks)).cast("int"))
        met = b.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(dealt, "block").where(_others()).drop("block")
    brand, content, kind = _set_similarity()
    rest = met.select(F.col("a.id").alias("id"), F.col("a.title").alias("a_title"), F.col("b.title").alias("b_title"), F.col("a.letters").alias("a_letters"), F.col("b.letters").alias("b_letters"), (brand * ARTICLE_BRANDS + content * ARTICLE_CONTENT + kind * ARTICLE_TYPE).alias("rest"))
    floor = materialise(rest.groupBy("id").agg(F.max("rest").alias("floor")), "floor")  # a row for each article of the batch
    left = rest.join(floor, "id").where(F.col("rest") + ARTICLE_TITLE >= F.col("floor") - 1e-9)
    need = (F.col("floor") - F.col("rest")) / ARTICLE_TITLE
    may = left.where(title_bound(F.col("a_letters"), F.col("b_letters")) >= need - 1e-9)  # before any title goes to Python
    score = F.lit(ARTICLE_TITLE) * title_similarity(F.col("a_title"), F.col("b_title"), need) + F.col("rest")
    best = may.withColumn("score", score).groupBy("id").agg(F.max("score").alias("greatest"))
    return batch.select("id").join(best, "id", "left").select("id", novelty(F.col("greatest")).alias("novelty"))


def _units(prepared: DataFrame) -> DataFrame:
    """Signals that are alike in type, brands and features count as one: ``unit`` (its number), with the smallest and the largest id."""
    sets = [F.first(c).alias(c) for c in ("kind", "brands", "features")]
    return materialise(prepared.groupBy("form").agg(*sets, F.min("id").alias("low"), F.max("id").alias("high")).withColumn("unit", F.monotonically_increasing_id()), "signal-units")


#: Brands that stand side by side in a signal's sorted brands and are looked for together.
RUNS = (1, 4)
#: Brands that more units have are asked for by size, too.
COMMON = 64


def _ordered(units: DataFrame, terms: DataFrame) -> DataFrame:
    """``units`` with ``n``, how many brands they have, and ``terms``, those brands that ``terms`` has a number for, the rarest first; the last ``common`` of them are those that many units have."""
    known = units.select("unit", F.explode("brands").alias("brand")).join(terms, "brand").groupBy("unit").agg(F.transform(F.array_sort(F.collect_list(F.struct("held", "term"))), lambda t: t["term"]).alias("terms"), F.count_if(F.col("held") > COMMON).alias("common"))
    return materialise(units.join(known, "unit").select("unit", "form", "kind", "features", F.size("brands").alias("n"), "terms", "common", "low", "high"), "signal-terms")


def _floors(mine: DataFrame, theirs: DataFrame) -> DataFrame:
    """``unit`` and ``floor``: a similarity that every signal of the unit has at least with a recent one that isn't itself.

    Nothing is compared. For each type and run of brands the two smallest sets that have it are known: with a set of m, a
    set of n that has the same run of r has at least r / (n + m - r) in common. Two hashes name a run, since a false one
    would promise too much. Two signals in a unit are as alike as can be.
    """

    def promises(units: DataFrame) -> DataFrame:
        def of(run: int, tag: Column, features: float) -> Column:
            place = F.when(F.size("terms") >= run, F.sequence(F.lit(1), F.size("terms") - run + 1)).otherwise(F.array().cast("array<int>"))
            name = lambda i: [F.lit(run), tag, F.col("kind"), F.slice("sorted", i, F.lit(run))]
            return F.transform(place, lambda i: F.struct(F.xxhash64(*name(i)).alias("h"), F.xxhash64(F.lit("2"), *name(i)).alias("h2"), F.lit(run).alias("run"), F.lit(features).alias("more")))

        with_features = F.when(F.size("features") > 0, of(1, F.to_json("features"), SIGNAL_FEATURES)).otherwise(of(1, F.lit(""), 0.0).cast("array<struct<h:bigint,h2:bigint,run:int,more:double>>"))
        named = F.array_distinct(F.concat(*(of(run, F.lit(""), 0.0) for run in RUNS), with_features))
        return units.where("kind IS NOT NULL").withColumn("sorted", F.array_sort("terms")).select("unit", "n", "low", "high", F.explode(named).alias("k")).select("unit", "n", "low", "high", "k.*")

    who = F.explode(F.array_distinct(F.transform(F.array("low", "high"), lambda x: F.xxhash64(x))))
    turn = F.row_number().over(W.partitionBy("h", "h2").orderBy("n", "who"))
    two = promises(theirs).select("h", "h2", "n", who.alias("who")).withColumn("turn", turn).where("turn <= 2")
    of = lambda t, c: F.max(F.when(F.col("turn") == t, F.col(c)))
    held = two.groupBy("h", "h2").agg(of(1, "n").alias("m1"), of(1, "who").alias("who1"), of(2, "n").alias("m2"), of(2, "who").alias("who2")).where("who2 <> who1")
    other = F.when((F.col("low") == F.col("high")) & (F.xxhash64("low") != F.col("who1")), F.col("m1")).otherwise(F.col("m2"))
    run = F.col("run").cast("double")
    floors = promises(mine).join(held, ["h", "h2"]).groupBy("unit").agg(F.max(run / (F.col("n") + other - run) * SIGNAL_BRANDS + F.col("more") + SIGNAL_TYPE).alias("floor"))
    several = theirs.groupBy("kind").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low <> high").select("kind", F.lit(SIGNAL_TYPE).alias("typed"))
    same = SIGNAL_BRANDS + F.when(F.size("features") > 0, SIGNAL_FEATURES).otherwise(0.0) + F.when(F.col("kind").isNotNull(), SIGNAL_TYPE).otherwise(0.0)
    whole = theirs.where("low <> high").select("form", same.alias("whole"))
    all_of = mine.select("unit", "form", "kind").join(floors, "unit", "left").join(several, "kind", "left").join(whole, "form", "left")
    return all_of.select("unit", F.coalesce(F.greatest("floor", "typed", "whole"), F.lit(0.0)).alias("floor"))


def _rivals(mine: DataFrame, theirs: DataFrame) -> DataFrame:
    """``unit`` and ``other``: all pairs with a brand in common that can be more alike than the ``floor`` of ``mine``.

    They meet on their first common brand, the rarest first, and differ in what else they have in common: type and a
    feature, type, a feature, or nothing. Each leaves so much for the brands to give, ``need``. As far as a set of n can
    have r brands in common from there on, the other has at most r * (1 + 1 / need) - n of them, so a brand that many
    have is asked for among small sets only: there sets lie in classes by the size's power of two.
    """
    none = F.array().cast("array<struct<group:bigint,base:double>>")
    group = lambda base, *name: F.struct(F.xxhash64(F.lit(str(base)), *name).alias("group"), F.lit(base).alias("base"))
    typed = F.col("kind").isNotNull()
    groups = F.concat(
        F.array(group(0.0)), F.when(typed, F.array(group(SIGNAL_TYPE, F.col("kind")))).otherwise(none), F.transform("features", lambda f: group(SIGNAL_FEATURES, f)),
        F.when(typed, F.transform("features", lambda f: group(SIGNAL_TYPE + SIGNAL_FEATURES, F.col("kind"), f))).otherwise(none),
    )
    need = lambda floor: F.greatest((floor - F.col("base")) / SIGNAL_BRANDS, F.lit(1e-9))
    size = lambda n: F.floor(F.log2(n)).cast("int")
    by_size = lambda of: F.when(F.col("left") <= F.col("common"), of).otherwise(F.array(F.lit(-1)))
    rows = lambda df: df.withColumn("g", F.explode(groups)).select("*", "g.*").drop("g")
    key = F.xxhash64("group", "term").alias("key")
    asked = rows(mine).withColumn("need", need(F.col("floor"))).select("unit", "n", "need", "group", "common", F.size("terms").alias("known"), F.posexplode("terms").alias("at", "term"))
    asked = asked.select("unit", "n", "need", "common", key, (F.col("known") - F.col("at")).alias("left"))
    least, most = F.greatest(F.lit(1), F.ceil(F.col("n") * F.col("need") - 1e-9)), F.floor(F.least(F.col("left") * (1 + 1 / F.col("need")) - F.col("n") + 1e-9, F.lit(2.0**30)))
    asked = asked.where(least <= most).withColumn("class", F.explode(by_size(F.sequence(size(least), size(most))))).drop("common")
    lowest = mine.agg(F.min("floor")).first()[0]  # what no unit is under
    kept = rows(theirs).withColumn("lowest", need(F.lit(lowest).cast("double"))).select("unit", "n", "lowest", "group", "common", F.size("terms").alias("known"), F.posexplode("terms").alias("at", "term")).withColumn("left", F.col("known") - F.col("at"))
    kept = kept.where(F.col("left") >= F.col("n") * F.col("lowest") - 1e-9).select(F.col("unit").alias("other"), F.col("n").alias("m"), key, F.col("left").alias("their_left"), by_size(F.array(size(F.col("n"))))[0].alias("class"))
    reach = F.least("left", "their_left") * (1 + F.col("need")) > (F.col("n") + F.col("m")) * F.col("need") * (1 + 1e-12)
    return asked.join(kept, ["key", "class"]).where(reach).select("unit", "other").distinct()


def signal_novelty(signals: DataFrame, recent: DataFrame, common: int = COMMON_TERMS) -> DataFrame:
    """Novelty of every signal by type, brands, features and source articles.

    A pair that shares none of these has similarity 0. Signals of one type with equal brands and features count as one;
    what these give is looked for in blocks (``nearest``), pairs with a source in common are compared one by one, and the
    type alone gives 0.3 if another recent signal has it.
    """

    def prepared(df: DataFrame) -> DataFrame:
        sets = df.select("id", F.nullif("signal_type", F.lit("")).alias("tag"), *(lower_set(F.col(c)).alias(n) for c, n in (("brands_mentioned", "a"), ("features_mentioned", "b"), ("source_article_ids", "sources"))))
        return sets.withColumns({"a": F.array_sort("a"), "b": F.array_sort("b"), "who": _who(F.lit(None).cast("string"), F.col("id"))}).withColumn("form", F.md5(F.to_json(F.struct("tag", "a", "b"))))

    a = materialise(prepared(signals), "signal-sets")  # read several times
    b = a if recent is signals else materialise(prepared(recent), "signal-sets")
    kinds = b.where("tag IS NOT NULL").groupBy("tag").agg(F.min("who").alias("from"), F.max("who").alias("to"))
    typed = lambda asked: asked.join(kinds, "tag").where("who <> from OR who <> to").select("unit", F.lit(SIGNAL_TYPE).alias("floor"))
    parts = (("tag", SIGNAL_TYPE), ("a", SIGNAL_BRANDS), ("b", SIGNAL_FEATURES))
    found = greatest_alike(a, b, parts, typed, common=common)
    by_sets = a.select("id", "form", "who").join(found.hint("merge"), ["form", "who"]).select("id", "greatest")

    of = lambda df, side: df.select(F.explode("sources").alias("source"), F.struct("id", "tag", "a", "b", "sources").alias(side))
    shared = of(a, "x").join(of(b, "y").hint("merge"), "source")
    shared = shared.where(~F.col("x.id").eqNullSafe(F.col("y.id")) & (F.array_min(F.array_intersect("x.sources", "y.sources")) == F.col("source")))
    alike = F.when(F.coalesce(F.col("x.tag") == F.col("y.tag"), F.lit(False)), 1.0).otherwise(0.0)
    brands, features, sources = (jaccard_of_sets(F.col(f"x.{n}"), F.col(f"y.{n}")) for n in ("a", "b", "sources"))
    score = alike * SIGNAL_TYPE + brands * SIGNAL_BRANDS + features * SIGNAL_FEATURES + sources * SIGNAL_SOURCES
    return _novelty_of(a, by_sets.unionByName(shared.select(F.col("x.id").alias("id"), score.alias("greatest"))))
