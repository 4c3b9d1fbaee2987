"""Queries on articles: queues, duplicates, signals, novelty."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sets import jaccard
from ..operators import block_index, dedup, novelty, signals
from ..operators.components import Components, connected_components, no_components, with_edges
from ..sources import queues, snapshots
from ..tables import materialise, workspace
from .comparison_queries import FEATURES
from .fixtures import articles, features

AS_OF = datetime(2024, 1, 5)

ARTICLES = r"""w AS (
  SELECT *, list_filter(string_split_regex(lower(text), '[^a-zà-ÿ]+'), lambda x: length(x) >= 10) AS w FROM documents),
a AS (
  SELECT doc_id::VARCHAR AS id, doc_id AS ord, source AS source_name, lang AS language, 'https://example.org/' || source || '/' || (doc_id % 700)::VARCHAR AS source_url,
    substr(regexp_extract(text, '^[^.!?\n]*[.!?]?'), 1, 200) AS title_en, text AS body_en,
    list_sort(list_distinct(list_filter(w, lambda x: length(x) = 10))) AS brands_mentioned, list_sort(list_distinct(list_filter(w, lambda x: length(x) > 10))) AS vehicles_mentioned,
    timestamp '2024-01-01' + to_minutes((doc_id * 7)::INT) AS scrape_date,
    CASE WHEN doc_id % 7 = 0 THEN NULL ELSE timestamp '2024-01-01' + to_minutes((doc_id * 7 - 60)::INT) END AS publish_date,
    ['adas', 'ai_assistant', 'infotainment', 'connectivity', 'ota', 'battery_software', 'cockpit_ux'][length(regexp_extract(text, '[A-Za-zÀ-ÿ]+')) % 7 + 1] AS category,
    ['news', 'review', 'teardown', 'forum_post', 'opinion', 'regulatory', 'earnings'][(n_chars % 5)::INT + 1] AS content_type,
    (1 + n_chars % 10)::INT AS relevance_score, n_chars % 3 = 0 AS is_new, doc_id % 4 <> 0 AS processed,
    CASE WHEN doc_id % 6 = 0 THEN NULL ELSE doc_id % 5 = 0 END AS phase2_processed,
    CASE WHEN n_chars % 2 = 0 THEN 'impact ' || lang ELSE NULL END AS competitive_signal,
    coalesce(list_sort(list_distinct(list_filter(w, lambda x: length(x) > 10)))[1], '') AS feature_name
  FROM w)"""
JACCARD = "coalesce(len(list_intersect({0}, {1})) / nullif(len(list_distinct(list_concat({0}, {1}))), 0), 0)"
PAIRS = f"""e AS (SELECT *, coalesce(publish_date, scrape_date) AS at FROM a),
p AS (
  SELECT x.id AS a, y.id AS b, x.ord AS a_ord, y.ord AS b_ord, x.title_en = y.title_en AND x.title_en <> '' AS same_title,
    {JACCARD.format("x.brands_mentioned", "y.brands_mentioned")} AS brand, {JACCARD.format("x.vehicles_mentioned", "y.vehicles_mentioned")} AS vehicle, (x.category = y.category)::INT AS category
  FROM e x JOIN e y ON x.ord < y.ord AND x.source_name IS DISTINCT FROM y.source_name AND y.at BETWEEN x.at - INTERVAL 72 HOUR AND x.at + INTERVAL 72 HOUR
  WHERE list_has_any(x.brands_mentioned, y.brands_mentioned) OR list_has_any(x.vehicles_mentioned, y.vehicles_mentioned))"""


def dedup_set_score_pairs(spark, sf_dir):
    return dedup.set_score_pairs(articles(spark, sf_dir)).withColumn("score", F.round("score", 6))


def exact_title_pairs(rows: DataFrame) -> DataFrame:
    """Candidate pairs whose titles are equal, with the title's full weight: the part of the score that SQL can follow."""
    brand, vehicle, category = dedup.set_scores()
    prepared = materialise(dedup.prepare(rows), "prepared")
    score = F.lit(dedup.TITLE) + brand * dedup.BRANDS + vehicle * dedup.VEHICLES + category * dedup.CATEGORIES + F.lit(dedup.CLOSE)
    slim = lambda x: F.struct(F.col(f"{x}.id").alias("id"), F.col(f"{x}.ord").alias("ord"))
    pairs = dedup.hopeful_pairs(prepared).withColumn("score", score).where(F.col("score") >= dedup.THRESHOLD - 1e-9).withColumns({"a": slim("a"), "b": slim("b")})
    same = dedup.with_titles(pairs, prepared).where((F.col("a_title") == F.col("b_title")) & (F.col("a_title") != ""))
    return same.select(F.col("a.id").alias("a"), F.col("b.id").alias("b"), F.col("a.ord").alias("a_ord"), F.col("b.ord").alias("b_ord"), "score")


def dedup_components(spark, sf_dir):
    return connected_components(exact_title_pairs(articles(spark, sf_dir)), "a_ord", "b_ord")


def components_in_batches(spark, sf_dir):
    """The same components from two batches of pairs, each a run on the labels and merges that the ones before stored."""
    pairs = materialise(exact_title_pairs(articles(spark, sf_dir)), "pairs")
    into = snapshots.RunStore(spark, workspace(spark, "components"))
    for run in range(2):
        base, edges = into.snapshot(), pairs.where(F.pmod(F.col("a_ord") + F.col("b_ord"), F.lit(2)) == run)
        if base.version:
            ends = edges.select(F.explode(F.array("a_ord", "b_ord")).alias("id"))
            before = Components(into.matching(base, "labels", ends), into.read("merges", base))
        else:
            before = no_components(spark)
        added = with_edges(before, edges, "a_ord", "b_ord")
        into.commit(base, f"batch {run}", {"labels": into.upsert(base, "labels", added.labels, ["id"], buckets=64), "merges": into.upsert(base, "merges", added.merges, ["component"], buckets=16)})
    return Components(into.read("labels"), into.read("merges")).resolved()


def dedup_groups(spark, sf_dir):
    rows = articles(spark, sf_dir)
    groups = dedup.duplicate_groups(rows, exact_title_pairs(rows))
    return groups.select("canonical_id", "duplicate_group_id", "member_ids", F.size("scores").cast("long").alias("n_links"))


def dedup_full_pairs(spark, sf_dir):
    return dedup.scored_pairs(articles(spark, sf_dir)).select("a", "b", F.round("score", 6).alias("score"))


def dedup_full_groups(spark, sf_dir):
    rows = articles(spark, sf_dir)
    return dedup.duplicate_groups(rows, dedup.scored_pairs(rows))


def dedup_marked(spark, sf_dir):
    rows = articles(spark, sf_dir)
    return dedup.mark_duplicates(rows, dedup_groups_of(rows)).select("id", "is_duplicate", "canonical_article_id", "duplicate_group_id")


def dedup_groups_of(rows: DataFrame) -> DataFrame:
    return dedup.group_members(rows, exact_title_pairs(rows))


def dedup_two_runs(spark, sf_dir):
    """The older four fifths are marked; when the rest has come, all are grouped again and late members join."""
    slim = F.transform("features_extracted", lambda f: f.withField("description", F.lit(None).cast("string")))
    rows = articles(spark, sf_dir).drop("body_en").withColumn("features_extracted", slim)  # both runs' tables are stored: without texts
    early = rows.where("ord % 5 <> 0")
    first = materialise(dedup.mark_duplicates(early, dedup_groups_of(early)), "first-run")
    late = rows.where("ord % 5 = 0").withColumn("canonical_article_id", F.lit(None).cast("string"))
    every = materialise(first.unionByName(late), "second-run")
    return dedup.mark_duplicates(every, dedup_groups_of(every)).select("id", "is_duplicate", "canonical_article_id", "duplicate_group_id")


def dedup_indexed_pairs(spark, sf_dir):
    """Pairs with equal titles that three runs find, each comparing its third of the articles with the index of all before it."""
    rows, store = articles(spark, sf_dir), snapshots.RunStore(spark, workspace(spark, "blocks"))
    # As many buckets as shuffle partitions, or Spark would shuffle the index with the batch.
    index = block_index.BlockIndex(store, buckets=max(64, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    for run in range(3):
        block_index.duplicate_run(index, f"run {run}", rows.where(F.pmod("ord", F.lit(3)) == run), buckets=64)
    return store.read("pairs").where("title = 1").select("a", "b", "run", F.round("score", 6).alias("score"))


def _signal(rule, *fields):
    """The candidates of a rule; of what set it off the named fields, long ones as their MD5."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = rule(articles(spark, sf_dir))
        of = lambda f: F.get_json_object("trigger_data", f"$.{f}")
        return found.select("signal_type", "article_id", "brands_mentioned", "features_mentioned", *((F.md5(of(f)) if f == "description" else of(f)).alias(f"trigger_{f}") for f in fields))

    return query


def stored_signals(spark, sf_dir):
    """Signals without the trickle-down rule, as rows with an id and sources."""
    found = signals.signal_candidates(articles(spark, sf_dir), None)
    return found.select(F.concat_ws("/", "signal_type", "article_id").alias("id"), "signal_type", "brands_mentioned", "features_mentioned", F.array("article_id").alias("source_article_ids"), F.col("article_id").cast("long").alias("ord"))


def signal_novelty(spark, sf_dir):
    """Every signal against all others."""
    every = stored_signals(spark, sf_dir)
    return novelty.signal_novelty(every, every).withColumn("novelty", F.round("novelty", 6))


def article_novelty_sets(spark, sf_dir):
    rows = articles(spark, sf_dir)
    return novelty.article_set_novelty(rows, rows).withColumn("novelty", F.round("novelty", 6))


def article_novelty(spark, sf_dir):
    """The newest articles of the second-phase queue against the processed ones of the week before the newest."""
    rows = articles(spark, sf_dir)
    batch = queues.phase2_queue(rows)
    newest = rows.agg(F.max("scrape_date")).first()[0]
    return novelty.article_novelty(batch, queues.recent_processed(rows, newest, 24 * novelty.ARTICLE_DAYS)).withColumn("novelty", F.round("novelty", 6))


def url_anti_join_cap(spark, sf_dir):
    rows = articles(spark, sf_dir)
    return queues.new_listings(rows.where("NOT processed"), rows.where("processed AND phase2_processed")).select("source_url", "source_name", "id", "turn")


def _rule_sql(kind: str, where: str, mentions: str = "[feature_name]", **trigger: str) -> str:
    more = "".join(f", {sql} AS trigger_{name}" for name, sql in trigger.items())
    return f"SELECT '{kind}' AS signal_type, id AS article_id, brands_mentioned, {mentions} AS features_mentioned{more} FROM a WHERE {where}"


def _any(text: str, words) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


def _found(text: str, words) -> str:
    return f"to_json(list_filter({list(words)}, lambda k: contains({text}, k)))::VARCHAR"


_TEXT = "lower(title_en || ' ' || body_en)"
AI = f"""(category = 'ai_assistant' AND is_new OR content_type IN ('news', 'opinion') AND {_any(_TEXT, signals.AI_KEYWORDS)})"""
CHIP = f"""category = 'adas' AND {_any("lower(body_en)", signals.CHIP_KEYWORDS)}"""
_NAME = "vehicles_mentioned[1]"
_FRESH = "category = 'ai_assistant' AND is_new"
RULES = {
    "signal_new_feature": ("new_feature_launch", "is_new", "[feature_name]", {"feature_name": _NAME, "category": "category", "description": "md5(body_en)"}),
    "signal_ai": (
        "ai_integration", AI, "CASE WHEN category = 'ai_assistant' THEN [feature_name] ELSE [] END",
        {"trigger_reason": f"CASE WHEN {_FRESH} THEN 'new_ai_feature' ELSE 'ai_keyword_match' END", "matched_keywords": f"CASE WHEN {_FRESH} THEN '[]' ELSE {_found(_TEXT, signals.AI_KEYWORDS)} END", "feature_name": f"CASE WHEN {_FRESH} THEN {_NAME} END"},
    ),
    "signal_ota": ("ota_deployment", "is_new AND category = 'ota'", "[feature_name]", {"feature_name": _NAME, "description": "md5(body_en)"}),
    "signal_partnership": ("partnership_change", "len(brands_mentioned) >= 2 AND competitive_signal <> ''", "[]::VARCHAR[]", {"competitive_signal": "competitive_signal", "brand_count": "len(brands_mentioned)::VARCHAR"}),
    "signal_chip": ("chip_hardware_announcement", CHIP, "[feature_name]", {"feature_name": _NAME, "matched_keywords": _found("lower(body_en)", signals.CHIP_KEYWORDS), "description": "md5(body_en)"}),
}
_RULE_OF = {"signal_new_feature": signals.new_feature_launches, "signal_ai": signals.ai_integrations, "signal_ota": signals.ota_deployments, "signal_partnership": signals.partnership_changes, "signal_chip": signals.chip_announcements}


def with_part_category(rows: DataFrame) -> DataFrame:
    """Articles whose features are in the categories that the parts have, so that the trickle-down rule finds company."""
    of = F.element_at(F.array(*(F.lit(c) for c in ("gear", "ring", "bolt", "rod", "plate", "anvil", "widget", "gizmo"))), (F.col("ord") % 8 + 1).cast("int"))
    brand = F.concat(F.lit("BRAND#"), (F.col("ord") % 55).cast("string"))
    return rows.withColumns({"features_extracted": F.transform("features_extracted", lambda f: f.withField("category", of)), "brands_mentioned": F.array_append("brands_mentioned", brand)})


def with_second_feature(rows: DataFrame) -> DataFrame:
    """Articles with another feature, in a category that the parts have, and a brand of them: all six rules find something."""
    second = with_part_category(rows)
    return rows.join(second.select("id", F.col("features_extracted").alias("more"), F.col("brands_mentioned").alias("named")), "id").select(
        *(c for c in rows.columns if c not in ("features_extracted", "brands_mentioned")), F.concat("features_extracted", "more").alias("features_extracted"), F.col("named").alias("brands_mentioned")
    )


def signal_trickle_down(spark, sf_dir):
    """Counted by article, for its rows are as many as the features of other brands."""
    return signals.trickle_down_counts(with_part_category(articles(spark, sf_dir)), features(spark, sf_dir))


def signal_trickle_down_rows(spark, sf_dir):
    """The matches themselves, one row for each article, brand and feature name."""
    met = signals.trickle_down_totals(with_part_category(articles(spark, sf_dir)), features(spark, sf_dir))
    return met.select(F.col("id").alias("article_id"), "existing_brand", "existing_feature", "n")


QUERIES = {
    "scan_unprocessed_topk": lambda s, d: queues.unprocessed(articles(s, d)).select("id", "scrape_date"),
    "scan_recent_window": lambda s, d: queues.recent_processed(articles(s, d), AS_OF).select("id", "scrape_date"),
    "scan_phase2_queue": lambda s, d: queues.phase2_queue(articles(s, d), None).select("id", "scrape_date"),
    "scan_array_contains": lambda s, d: queues.signals_of_article(stored_signals(s, d), "33").select("id", "signal_type"),
    "phase2_chunks": lambda s, d: queues.chunks(queues.phase2_queue(articles(s, d)), "ord", 40).select("id", "chunk"),
    "url_anti_join_cap": url_anti_join_cap,
    "corpus_union_batch": lambda s, d: queues.corpus_without_batch(queues.recent_processed(articles(s, d), AS_OF), queues.phase2_queue(articles(s, d))).select("id", "source_name"),
    "jaccard_brands_vehicles": lambda s, d: articles(s, d).select("id", F.round(jaccard(F.col("brands_mentioned"), F.col("vehicles_mentioned")), 6).alias("similarity")),
    "dedup_set_score_pairs": dedup_set_score_pairs,
    "dedup_components": dedup_components,
    "components_in_batches": components_in_batches,
    "dedup_groups": dedup_groups,
    "dedup_marked": dedup_marked,
    "dedup_full_pairs": dedup_full_pairs,
    "dedup_full_groups": dedup_full_groups,
    "dedup_two_runs": dedup_two_runs,
    "dedup_indexed_pairs": dedup_indexed_pairs,
    "signal_trickle_down": signal_trickle_down,
    "signal_trickle_down_rows": signal_trickle_down_rows,
    **{name: _signal(rule, *RULES[name][3]) for name, rule in _RULE_OF.items()},
    "signal_counts_by_type": lambda s, d: signals.signal_counts(with_second_feature(articles(s, d)), features(s, d)),
    "signal_novelty": signal_novelty,
    "article_novelty_sets": article_novelty_sets,
    "article_novelty": article_novelty,
}

_EXACT = f"""{ARTICLES}, {PAIRS}, l AS (SELECT * FROM p WHERE same_title AND 0.3 + brand * 0.25 + vehicle * 0.2 + category * 0.15 + 0.1 >= 0.75 - 1e-9),
u AS (SELECT a_ord AS a, b_ord AS b FROM l UNION SELECT b_ord, a_ord FROM l),
r AS (SELECT a AS id, a AS other FROM u UNION SELECT r.id, u.b FROM r JOIN u ON u.a = r.other),
c AS (SELECT id, min(other) AS component FROM r GROUP BY 1)"""
_GROUPS = f"""WITH RECURSIVE {_EXACT}, k AS (
  SELECT component, arg_min(a.id, (scrape_date, -relevance_score, ord)) AS canonical_id, min(a.id) AS duplicate_group_id, list(a.id ORDER BY ord) AS member_ids FROM c JOIN a ON a.ord = c.id GROUP BY 1)"""
_STORED = "s AS (" + " UNION ALL ".join(f"SELECT *, article_id::BIGINT AS ord FROM ({_rule_sql(*rule[:3])})" for rule in RULES.values()) + ")"
_PARTS = f"""{ARTICLES}, {FEATURES}, n AS (SELECT *, ['gear', 'ring', 'bolt', 'rod', 'plate', 'anvil', 'widget', 'gizmo'][(ord % 8)::INT + 1] AS kind, list_append(brands_mentioned, 'brand#' || (ord % 55)::VARCHAR) AS named FROM a)"""
_LINKED = """u AS (SELECT a_ord AS a, b_ord AS b FROM {l} UNION SELECT b_ord, a_ord FROM {l}),
r AS (SELECT a AS id, a AS other FROM u UNION SELECT r.id, u.b FROM r JOIN u ON u.a = r.other),
c AS (SELECT id, min(other) AS component FROM r GROUP BY 1)"""
_NOVELTY_JACCARD = {n: JACCARD.format(f"x.{n}", f"y.{n}") for n in ("brands_mentioned", "features_mentioned")}

ORACLE_SQL = {
    "scan_unprocessed_topk": f"WITH {ARTICLES} SELECT id, scrape_date FROM a WHERE NOT processed ORDER BY scrape_date, id LIMIT 50",
    "scan_recent_window": f"WITH {ARTICLES} SELECT id, scrape_date FROM a WHERE processed AND scrape_date >= timestamp '2024-01-02'",
    "scan_phase2_queue": f"WITH {ARTICLES} SELECT id, scrape_date FROM a WHERE processed AND NOT coalesce(phase2_processed, false)",
    "scan_array_contains": f"WITH {ARTICLES}, {_STORED} SELECT signal_type || '/' || article_id AS id, signal_type FROM s WHERE article_id = '33'",
    "phase2_chunks": f"WITH {ARTICLES}, q AS (SELECT * FROM a WHERE processed AND NOT coalesce(phase2_processed, false) ORDER BY scrape_date DESC, id LIMIT 100) SELECT id, (row_number() OVER (ORDER BY ord) - 1) // 40 AS chunk FROM q",
    "url_anti_join_cap": f"""WITH {ARTICLES}, n AS (SELECT * FROM a WHERE NOT processed AND source_url NOT IN (SELECT source_url FROM a WHERE processed AND phase2_processed) QUALIFY row_number() OVER (PARTITION BY source_url ORDER BY ord) = 1)
SELECT source_url, source_name, id, (row_number() OVER (PARTITION BY source_name ORDER BY ord))::INT AS turn FROM n QUALIFY turn <= 25""",
    "corpus_union_batch": f"""WITH {ARTICLES}, b AS (SELECT * FROM a WHERE processed AND NOT coalesce(phase2_processed, false) ORDER BY scrape_date DESC, id LIMIT 100)
SELECT id, source_name FROM b UNION ALL SELECT id, source_name FROM a WHERE processed AND scrape_date >= timestamp '2024-01-02' AND id NOT IN (SELECT id FROM b)""",
    "jaccard_brands_vehicles": f"WITH {ARTICLES} SELECT id, round({JACCARD.format('brands_mentioned', 'vehicles_mentioned')}, 6) AS similarity FROM a",
    "dedup_set_score_pairs": f"WITH {ARTICLES}, {PAIRS} SELECT a, b, round(brand * 0.25 + vehicle * 0.2 + category * 0.15 + 0.1, 6) AS score FROM p",
    "dedup_components": f"WITH RECURSIVE {_EXACT} SELECT id, component FROM c",
    "components_in_batches": f"WITH RECURSIVE {_EXACT} SELECT id, component FROM c",
    "dedup_indexed_pairs": f"""WITH {ARTICLES}, {PAIRS.replace("x.title_en = y.title_en", "lower(x.title_en) = lower(y.title_en)")}
SELECT a, b, 'run ' || greatest(a_ord % 3, b_ord % 3)::VARCHAR AS run, round(0.3 + brand * 0.25 + vehicle * 0.2 + category * 0.15 + 0.1, 6) AS score FROM p
WHERE same_title AND 0.3::DOUBLE + 0.25::DOUBLE * brand + 0.2::DOUBLE * vehicle + 0.15::DOUBLE * category + 0.1::DOUBLE >= 0.75::DOUBLE""",
    "dedup_groups": f"{_GROUPS} SELECT canonical_id, duplicate_group_id, member_ids, (SELECT count(*) FROM l JOIN c ON c.id = l.a_ord WHERE c.component = k.component) AS n_links FROM k",
    "dedup_marked": f"""{_GROUPS} SELECT a.id, CASE WHEN canonical_id IS NOT NULL THEN a.id <> canonical_id END AS is_duplicate, CASE WHEN a.id <> canonical_id THEN canonical_id END AS canonical_article_id, duplicate_group_id
FROM a LEFT JOIN c ON c.id = a.ord LEFT JOIN k ON k.component = c.component""",
    "dedup_two_runs": f"""WITH RECURSIVE {ARTICLES}, {PAIRS}, l AS (SELECT * FROM p WHERE same_title AND 0.3 + brand * 0.25 + vehicle * 0.2 + category * 0.15 + 0.1 >= 0.75 - 1e-9),
l1 AS (SELECT * FROM l WHERE a_ord % 5 <> 0 AND b_ord % 5 <> 0), {_LINKED.format(l="l1").replace("u AS", "u1 AS").replace("r AS", "r1 AS").replace("c AS", "c1 AS").replace("FROM u ", "FROM u1 ").replace("FROM r ", "FROM r1 ").replace("SELECT r.id, u.b FROM r1 JOIN u ON u.a = r.other", "SELECT r1.id, u1.b FROM r1 JOIN u1 ON u1.a = r1.other")},
k1 AS (SELECT component, arg_min(a.id, (scrape_date, -relevance_score, ord)) AS canonical_id, min(a.id) AS group_id FROM c1 JOIN a ON a.ord = c1.id GROUP BY 1),
m AS (SELECT a.*, k1.group_id, a.id = k1.canonical_id AS prior FROM a LEFT JOIN c1 ON c1.id = a.ord LEFT JOIN k1 ON k1.component = c1.component),
{_LINKED.format(l="l")},
k AS (SELECT component, coalesce(arg_min(m.id, ord) FILTER (prior), arg_min(m.id, (scrape_date, -relevance_score, ord))) AS canonical_id, coalesce(arg_min(group_id, ord) FILTER (group_id IS NOT NULL), min(m.id)) AS duplicate_group_id
  FROM c JOIN m ON m.ord = c.id GROUP BY 1)
SELECT a.id, CASE WHEN canonical_id IS NOT NULL THEN a.id <> canonical_id END AS is_duplicate, CASE WHEN a.id <> canonical_id THEN canonical_id END AS canonical_article_id, duplicate_group_id
FROM a LEFT JOIN c ON c.id = a.ord LEFT JOIN k ON k.component = c.component""",
    **{k: f"WITH {ARTICLES} {_rule_sql(*rule[:3], **rule[3])}" for k, rule in RULES.items()},
    "signal_trickle_down": f"""WITH {ARTICLES}, {FEATURES}, n AS (SELECT *, ['gear', 'ring', 'bolt', 'rod', 'plate', 'anvil', 'widget', 'gizmo'][(ord % 8)::INT + 1] AS kind, list_append(brands_mentioned, 'brand#' || (ord % 55)::VARCHAR) AS named FROM a WHERE is_new)
SELECT n.id AS article_id, count(*) AS n_matches, count(DISTINCT brand_name_en) AS n_brands, min(brand_name_en) AS first_brand FROM n JOIN f ON f.category = n.kind AND NOT list_contains(named, lower(brand_name_en)) GROUP BY 1""",
    "signal_trickle_down_rows": f"""WITH {ARTICLES}, {FEATURES}, n AS (SELECT *, ['gear', 'ring', 'bolt', 'rod', 'plate', 'anvil', 'widget', 'gizmo'][(ord % 8)::INT + 1] AS kind, list_append(brands_mentioned, 'brand#' || (ord % 55)::VARCHAR) AS named FROM a WHERE is_new)
SELECT n.id AS article_id, brand_name_en AS existing_brand, feature_name_en AS existing_feature, count(*) AS n FROM n JOIN f ON f.category = n.kind AND NOT list_contains(named, lower(brand_name_en)) GROUP BY 1, 2, 3""",
    "signal_counts_by_type": f"""WITH {_PARTS}, s AS (
  SELECT 'new_feature_launch' AS signal_type, 2 * count(*) AS n FROM n WHERE is_new
  UNION ALL SELECT 'feature_trickle_down', count(*) FROM n JOIN f ON f.category = n.kind AND NOT list_contains(named, lower(brand_name_en)) WHERE is_new
  UNION ALL SELECT 'ai_integration', count(*) FROM n WHERE {AI}
  UNION ALL SELECT 'ota_deployment', count(*) FROM n WHERE is_new AND category = 'ota'
  UNION ALL SELECT 'partnership_change', count(*) FROM n WHERE len(named) >= 2 AND competitive_signal <> ''
  UNION ALL SELECT 'chip_hardware_announcement', count(*) FROM n WHERE {CHIP})
SELECT signal_type, n AS n_signals FROM s""",
    "signal_novelty": f"""WITH {ARTICLES}, {_STORED} SELECT x.signal_type || '/' || x.article_id AS id, round(greatest(0, least(1, 1 - max((x.signal_type = y.signal_type)::INT * 0.3 + {_NOVELTY_JACCARD["brands_mentioned"]} * 0.35 + {_NOVELTY_JACCARD["features_mentioned"]} * 0.2
  + (x.article_id = y.article_id)::INT * 0.15))), 6) AS novelty FROM s x JOIN s y ON x.signal_type <> y.signal_type OR x.article_id <> y.article_id GROUP BY 1""",
    "article_novelty_sets": f"""WITH {ARTICLES}, n AS (SELECT *, list_distinct(list_append(vehicles_mentioned, category)) AS content FROM a)
SELECT x.id, round(greatest(0, least(1, 1 - max({JACCARD.format("x.brands_mentioned", "y.brands_mentioned")} * 0.25 + {JACCARD.format("x.content", "y.content")} * 0.25
  + (coalesce(x.content_type = y.content_type AND x.brands_mentioned[1] = y.brands_mentioned[1], false))::INT * 0.15))), 6) AS novelty FROM n x JOIN n y ON x.id <> y.id GROUP BY 1""",
}
