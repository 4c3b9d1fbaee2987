from datetime import datetime, timedelta
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from tidewell.functions import dates, jsonx, names, prices, sets, text
from tidewell.operators import comparison, dedup, entities, models, novelty, runs, signals, web
from tidewell.operators.components import connected_components
from tidewell.plans import pipelines
from tidewell.sources import queues, store

NOON = datetime(2026, 7, 10, 12)
EPOCH = datetime(1970, 1, 1) + timedelta(seconds=1783684800)
FEATURE = "struct<feature_name: string, category: string, description: string, supplier: string, is_new: boolean>"
ARTICLE = f"""id string, ord long, title_en string, body_en string, source_name string, source_url string, brands_mentioned array<string>, vehicles_mentioned array<string>, features_extracted array<{FEATURE}>,
publish_date timestamp, scrape_date timestamp, relevance_score int, content_type string, competitive_signal string, processed boolean, phase2_processed boolean, is_duplicate boolean, duplicate_group_id string"""


def article(i, **more):
    row = {
        "id": f"a{i}", "ord": i, "title_en": "BYD launches city pilot for the Seal", "body_en": None, "source_name": f"s{i}", "source_url": f"https://x.org/{i}", "brands_mentioned": ["BYD"], "vehicles_mentioned": ["Seal"],
        "features_extracted": [("City pilot", "adas", "Runs on one Orin chip", None, False)], "publish_date": NOON, "scrape_date": NOON + timedelta(hours=i), "relevance_score": 5, "content_type": "news",
        "competitive_signal": None, "processed": True, "phase2_processed": False, "is_duplicate": None, "duplicate_group_id": None,
    } | more
    return tuple(row.values())


@pytest.fixture(scope="module")
def make(spark):
    return lambda *rows: spark.createDataFrame(list(rows), ARTICLE)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def other(i, **more):
    return article(i, **({"title_en": "Battery swap stations open in Oslo", "brands_mentioned": ["NIO"], "vehicles_mentioned": ["ET5"], "features_extracted": [("Swap", "battery_software", None, None, True)]} | more))


# --- duplicates


def scores(df):
    return {(r.a, r.b): r.score for r in dedup.scored_pairs(df).collect()}


def test_same_story_scores_one_and_ignores_its_own_source(make):
    assert scores(make(article(0), article(1), article(2, source_name="s0"))) == pytest.approx({("a0", "a1"): 1.0, ("a1", "a2"): 1.0})


def test_two_missing_sources_are_the_same(make):
    assert scores(make(article(0, source_name=None), article(1, source_name=None))) == {}


@pytest.mark.parametrize(("late", "n"), [(timedelta(hours=72), 1), (timedelta(hours=72, microseconds=1), 0)])
def test_the_window_includes_its_end(make, late, n):
    assert len(scores(make(article(0), article(1, publish_date=NOON + late)))) == n


def test_a_missing_array_costs_its_weight(make):
    assert scores(make(article(0, vehicles_mentioned=None), article(1, vehicles_mentioned=None))) == pytest.approx({("a0", "a1"): 0.8})


def test_scrape_date_stands_in_and_undated_articles_pair_with_nothing(make):
    assert len(scores(make(article(0, publish_date=None), article(1)))) == 1
    assert scores(make(article(0, publish_date=None, scrape_date=None), article(1))) == {}


def test_pairs_equal_brute_force(make):
    words = ["adas", "pilot", "seal", "byd", "city", "launch"]
    rows = [article(i, title_en=" ".join(words[k % 6] for k in range(i, i + 4)), brands_mentioned=[["BYD"], ["NIO", "byd"], []][i % 3], vehicles_mentioned=[["Seal"], None][i % 2], publish_date=NOON + timedelta(hours=9 * i)) for i in range(24)]
    jac = lambda a, b: len(a & b) / len(a | b) if a | b else 0.0
    low = lambda xs: {x.lower() for x in xs or ()}
    want = {}
    for i, a in enumerate(rows):
        for b in rows[i + 1 :]:
            if abs(a[9] - b[9]) <= timedelta(hours=72):
                s = 0.3 * SequenceMatcher(None, a[2].lower(), b[2].lower()).ratio() + 0.25 * jac(low(a[6]), low(b[6])) + 0.2 * jac(low(a[7]), low(b[7])) + 0.15 + 0.1
                if s >= 0.75:
                    want[a[0], b[0]] = s
    assert scores(make(*rows)) == pytest.approx(want) and want


def groups(df):
    return dedup.duplicate_groups(df, dedup.scored_pairs(df)).collect()


def test_three_sources_make_one_group_and_stories_stay_apart(make):
    df = make(article(0), article(1), article(2), other(3), other(4))
    assert sorted((g.canonical_id, g.member_ids, len(g.scores)) for g in groups(df)) == [("a0", ["a0", "a1", "a2"], 3), ("a3", ["a3", "a4"], 1)]


def test_canonical_is_prior_then_earliest_then_most_relevant(make):
    late = {"scrape_date": NOON + timedelta(hours=9)}
    assert groups(make(article(0, **late), article(1)))[0].canonical_id == "a1"
    assert groups(make(article(0, scrape_date=NOON), article(1, scrape_date=NOON, relevance_score=9)))[0].canonical_id == "a1"
    found = groups(make(article(0), article(1, is_duplicate=False, duplicate_group_id="g7", **late)))[0]
    assert (found.canonical_id, found.duplicate_group_id) == ("a1", "g7")
    assert groups(make(article(0, scrape_date=None), article(1)))[0].canonical_id == "a1"


def test_marks_and_matches_of_one_article(make):
    df = make(article(0), article(1), other(2))
    marked = {r.id: (r.is_duplicate, r.canonical_article_id) for r in dedup.mark_duplicates(df, dedup.duplicate_groups(df, dedup.scored_pairs(df))).collect()}
    assert marked == {"a0": (False, None), "a1": (True, "a0"), "a2": (None, None)}
    assert [r.id for r in dedup.duplicates_of(df, "a1").collect()] == ["a0"]


def test_nothing_in_nothing_out(make):
    df = make()
    assert groups(df) == [] and signals.signal_candidates(df, None).count() == 0 and novelty.article_set_novelty(df, df).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (5, 5), (None, 3)], "a long, b long")
    got = {r.id: r.component for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


# --- scalar functions


@pytest.mark.parametrize(("a", "b", "want"), [("tide", "diet", 0.25), ("diet", "tide", 0.5), ("Same", "sAME", 1.0), ("", "x", 0.0), (None, "x", 0.0), ("ab" * 120, "ba" * 121, None)])
def test_title_ratio(spark, a, b, want):
    got = spark.createDataFrame([(a, b)], "a string, b string").select(text.title_similarity(F.col("a"), F.col("b"))).first()[0]
    assert got == (SequenceMatcher(None, a.lower(), b.lower()).ratio() if want is None else want)


@pytest.mark.parametrize(("value", "want"), [("2026-07-17", datetime(2026, 7, 17)), ("20260717", datetime(2026, 7, 17)), ("2026-07-17T08:00:00+08:00", datetime(2026, 7, 17)), ("2026-07-17 01:02", datetime(2026, 7, 17, 1, 2)), ("2026-07-17T01:02:03Z", datetime(2026, 7, 17, 1, 2, 3)), ("2026-7-1", None), (" 2026-07-17", None), ("2026", None), ("", None), ("x", None), (None, None), ("2026-13-01", None)])
def test_iso_dates(spark, value, want):
    assert one(spark, dates.parse_iso(F.lit(value).cast("string"))) == want


def as_of():
    return F.lit("2026-07-10 12:00:00").cast("timestamp")


@pytest.mark.parametrize(
    ("value", "want"),
    [("5分钟前", datetime(2026, 7, 10, 11, 55)), ("3小时前", datetime(2026, 7, 10, 9)), ("2天前", datetime(2026, 7, 8, 12)), ("昨天", datetime(2026, 7, 9, 12)), ("2026年7月9日 14:34", datetime(2026, 7, 9, 6, 34)),
     ("2026-7-9", datetime(2026, 7, 8, 16)), ("7月7日", datetime(2026, 7, 6, 16)), ("12月31日", datetime(2025, 12, 30, 16)), ("2026年13月1日", None), ("no date", None), ("", None)],
)
def test_listing_dates(spark, value, want):
    assert one(spark, dates.result_date(F.lit(value), as_of())) == want


def test_note_dates_and_epochs(spark):
    assert one(spark, dates.note_date(F.lit("07-18"), as_of())) == datetime(2025, 7, 17, 16)
    assert one(spark, dates.note_date(F.lit("编辑于 07-08"), as_of())) == datetime(2026, 7, 7, 16)
    assert one(spark, dates.note_date(F.lit("今天"), as_of())) == NOON
    assert one(spark, dates.absolute_date(F.lit("2026-07-18 20:13:23"), seconds=True)) == datetime(2026, 7, 18, 12, 13, 23)
    assert one(spark, dates.epoch_millis(F.lit(1783684800999))) == EPOCH
    assert one(spark, dates.epoch_millis_or_seconds(F.lit("1783684800").cast("double"))) == EPOCH


@pytest.mark.parametrize(("value", "tier"), [("149,999", "budget"), ("150,000-200,000", "mid"), ("300,000", "premium"), ("500,000", "premium"), ("500,001", "luxury"), ("15.98万", "budget"), ("TBD", "unknown"), ("", "unknown"), (None, "unknown")])
def test_price_tiers(spark, value, tier):
    assert one(spark, prices.price_tier(F.lit(value).cast("string"))) == tier


def test_sets_and_names(spark):
    arr = lambda *x: F.array(*(F.lit(v) for v in x)).cast("array<string>")
    assert one(spark, sets.jaccard(arr("A", "b"), arr("a", "C"))) == pytest.approx(1 / 3)
    assert one(spark, sets.jaccard(arr(), arr())) == 0.0 and one(spark, sets.jaccard(F.lit(None).cast("array<string>"), arr("x", None))) == 0.0
    assert [names.snake_to_camel(x) for x in ("source_url", "id", "a_bC_d")] == ["sourceUrl", "id", "aBcD"]
    assert [names.camel_to_snake(x) for x in ("sourceUrl", "id", "priceRangeCNY", "Url")] == ["source_url", "id", "price_range_c_n_y", "url"]


GOOD = '{"headline": "h", "relevance_score": %s, "content_type": "news"}'


@pytest.mark.parametrize(("value", "ok"), [(GOOD % 7, True), ("Sure! " + GOOD % 7 + " Bye", True), (GOOD % '"high"', False), (GOOD % 7.5, False), (GOOD % "true", False), (GOOD % "null", False), ('{"headline": "h"}', False), ("[1]", False), ("null", False), ("{", False), ("} {", False), (None, False)])
def test_triage_answers(spark, value, ok):
    assert (one(spark, jsonx.valid_triage(F.lit(value).cast("string"))) is not None) == ok


def test_null_values_count_as_keys(spark):
    import json

    full = json.dumps(dict.fromkeys(jsonx.EXTRACTION_KEYS))
    assert one(spark, jsonx.valid_extraction(F.lit(full))) == full
    assert one(spark, jsonx.valid_resolution(F.lit('{"name_en": ""}'))) is None


# --- signals and novelty


def test_each_rule(make, spark):
    fresh = [("Agent", "ai_assistant", None, None, True), ("Old", "ai_assistant", None, None, False), ("Push", "ota", "d", None, True)]
    df = make(article(0), article(1, features_extracted=fresh, brands_mentioned=["BYD", "BYD"], competitive_signal="deal"), article(2, features_extracted=None, title_en="A ChatGPT rival"), article(3, is_duplicate=True, features_extracted=fresh), article(4, features_extracted=[], content_type="review", title_en="gpt"))
    known = spark.createDataFrame([("NIO", "ota", "X"), ("byd", "ota", "Y"), ("", "ota", "Z"), ("NIO", "adas", "W"), ("XPeng", "ota", "V")], "brand_name_en string, category string, feature_name_en string")
    got = sorted((r.signal_type, r.article_id, tuple(r.features_mentioned)) for r in signals.signal_candidates(df, known).collect())
    assert got == sorted([
        ("new_feature_launch", "a1", ("Agent",)), ("new_feature_launch", "a1", ("Push",)), ("feature_trickle_down", "a1", ("Push",)), ("feature_trickle_down", "a1", ("Push",)), ("ai_integration", "a1", ("Agent", "Old")),
        ("ai_integration", "a2", ()), ("ota_deployment", "a1", ("Push",)), ("partnership_change", "a1", ()), ("chip_hardware_announcement", "a0", ("City pilot",)),
    ])
    counts = {r.signal_type: r.n_signals for r in signals.signals_by_type(signals.signal_candidates(df, None)).collect()}
    assert counts["feature_trickle_down"] == 0 and len(counts) == 6


def test_keywords_match_inside_words_in_their_order(spark):
    assert one(spark, text.keywords_in(F.lit("Monitoring a SOCIAL chip"), signals.CHIP_KEYWORDS)) == ["chip", "soc", "orin"]


def novelties(batch, recent):
    return {r.id: r.novelty for r in novelty.article_novelty(batch, recent).collect()}


def test_article_novelty(make):
    same, far = article(1, content_type="news"), other(2, brands_mentioned=[], vehicles_mentioned=[], features_extracted=[])
    assert novelties(make(article(0)), make(article(0), same)) == pytest.approx({"a0": 0.0})
    assert novelties(make(article(0)), make(article(0))) == {"a0": 1.0}
    assert novelties(make(article(0, duplicate_group_id="g")), make(article(1, duplicate_group_id="g"))) == {"a0": 1.0}
    a = novelties(make(article(0)), make(article(1, content_type="review")))["a0"]
    assert a == pytest.approx(0.15)
    ratio = SequenceMatcher(None, article(0)[2].lower(), far[2].lower()).ratio()
    assert novelties(make(article(0)), make(far)) == pytest.approx({"a0": 1 - 0.35 * ratio})


def test_signal_novelty(spark):
    schema = "id string, signal_type string, brands_mentioned array<string>, features_mentioned array<string>, source_article_ids array<string>"
    df = lambda *rows: spark.createDataFrame(list(rows), schema)
    score = lambda a, *b: novelty.signal_novelty(df(a), df(*b)).first().novelty
    me = ("1", "ota_deployment", ["BYD"], ["x"], ["a"])
    assert score(me, me) == 1.0 and score(me, ("2", *me[1:])) == pytest.approx(0.0)
    assert score(me, ("2", "other", ["NIO"], ["y"], ["a"])) == pytest.approx(0.85)
    assert score(me, me, ("2", "ota_deployment", [], [], [])) == pytest.approx(0.7)


# --- entities


def test_aliases_vehicles_and_the_budget(spark):
    aliases = spark.createDataFrame([("byd", "BYD"), ("li auto", "Li Auto"), ("lynk & co", "Lynk & Co"), ("li", "Wrong")], "alias string, canonical string")
    named = spark.createDataFrame([(i, i, i, 0, n) for i, n in enumerate(["　BYD ", "Li Auto L9", "Lynk & Co 08", "BYD", "nobody X", "Honor", "byd  Seal"])], "id long, ord long, row long, pos int, name string")
    split = {r.id: (r.brand, r.model) for r in entities.split_vehicles(named, aliases).collect()}
    assert split == {1: ("Li Auto", "L9"), 2: ("Lynk & Co", "08"), 6: ("BYD", "Seal")}
    resolved = {r.id: r.canonical for r in entities.resolve_brands(named, aliases).collect()}
    assert resolved[0] == resolved[3] == "BYD" and resolved[4] is None
    many = spark.createDataFrame([(i, i, i, 0, f"n{i % 30}") for i in range(90)], "id long, ord long, row long, pos int, name string")
    assert [r.key for r in entities.names_for_the_model(many, aliases).orderBy("turn").collect()] == [f"n{i}" for i in range(20)]


def test_features_go_to_the_first_resolved_brand(make, spark):
    aliases = spark.createDataFrame([("byd", "BYD")], "alias string, canonical string")
    answers = spark.createDataFrame([("newco", "NewCo Auto")], "key string, name_en string")
    df = make(other(0, brands_mentioned=["iQIYI", "Unknown", "byd"]), other(1, brands_mentioned=["NEWCO", "BYD"]), other(2, brands_mentioned=["Unknown"]), article(3))
    got = {r.article_id: r.brand_name_en for r in entities.promote_features(df, aliases, answers).collect()}
    assert got == {"a0": "BYD", "a1": "NEWCO"}


# --- comparison, queues, writes, runs


def test_tiers_are_all_there_and_averages_are_by_vehicle(spark):
    vehicles = spark.createDataFrame([("1", "A", "100,000"), ("2", "A", "120,000"), ("3", None, "90,000"), ("4", "B", None)], "id string, brand_name_en string, price_range_cny string")
    features = spark.createDataFrame([("1", "A", "adas"), ("2", "A", ""), ("3", "B", "ota")], "id string, brand_name_en string, category string")
    got = {r.tier: (r.vehicle_count, r.avg_features) for r in comparison.price_tier_stats(vehicles, features).collect()}
    assert got == {"budget": (3, pytest.approx(4 / 3)), "mid": (0, 0.0), "premium": (0, 0.0), "luxury": (0, 0.0), "unknown": (1, 1.0)}
    assert {(r.tier, r.category): r.avg_features for r in comparison.price_tier_categories(vehicles, features).collect()}[("budget", "uncategorized")] == pytest.approx(2 / 3)


def test_queues(make):
    rows = [article(i, processed=i % 2 == 0, phase2_processed=[None, True, False][i % 3]) for i in range(12)]
    df = make(*rows)
    assert [r.ord for r in queues.unprocessed(df, 3).collect()] == [1, 3, 5]
    assert [r.ord for r in queues.phase2_queue(df).collect()] == [8, 6, 2, 0]
    assert {r.ord for r in queues.recent_processed(df, NOON + timedelta(hours=10), 4).collect()} == {6, 8, 10}
    assert queues.find_one(df, id="a3", source_name=None).first().ord == 3
    listed = make(*(article(i, source_name="s", source_url=f"u{i % 8}") for i in range(40)), article(90, source_url=""))
    assert [r.ord for r in queues.new_listings(listed, listed.where("ord = 3"), 5).orderBy("ord").collect()] == [0, 1, 2, 4, 5]


def test_upsert_overwrites_with_nulls_but_keeps_first_seen(spark):
    old = spark.createDataFrame([("a", 1, "s", 10), ("b", 2, "s", 20)], "k string, v int, supplier string, first int")
    new = spark.createDataFrame([("a", None, 5), ("c", "t", 30)], "k string, supplier string, first int")
    got = {r.k: (r.v, r.supplier, r["first"]) for r in store.upsert(old, new, ["k"], ["first"]).collect()}
    assert got == {"a": (1, None, 10), "b": (2, "s", 20), "c": (None, "t", 30)}


def test_runs(spark):
    log = spark.createDataFrame([("a", "request"), ("a", "ingested"), ("b", "error"), ("c", "error"), ("c", "ingested")], "source_name string, kind string")
    every = spark.createDataFrame([(x,) for x in "abcd"], "source_name string")
    health = runs.health_by_source(log, every)
    assert {r.source_name: r.status for r in health.collect()} == {"a": "success", "b": "failure", "c": "partial", "d": "success"}
    assert runs.run_totals(health).first().errors == 2


def test_extraction_and_second_phase_runs(make, spark):
    df = make(*(article(i, processed=False) for i in range(6)))
    table, summary = pipelines.extraction_run(df)
    s = summary.first()
    assert s.total == 6 and s.succeeded + s.triage_skipped == 6 and table.where("processed").count() == 6
    broken = pipelines.extraction_run(df, lambda prompts: [None for _ in prompts])
    assert broken[1].first().failed == 6 and broken[0].where("NOT processed AND processing_error IS NOT NULL").count() == 6
    ready = make(article(0), article(1), other(2))
    aliases = spark.createDataFrame([("byd", "BYD"), ("nio", "NIO")], "alias string, canonical string")
    meta = spark.createDataFrame([("BYD", "g")], "name_en string, parent_group string")
    known = spark.createDataFrame([("XPeng", "battery_software", "S")], "brand_name_en string, category string, feature_name_en string")
    no_signals = spark.createDataFrame([], "id string, signal_type string, brands_mentioned array<string>, features_mentioned array<string>, source_article_ids array<string>")
    out = pipelines.second_phase(ready, known, aliases, meta, no_signals, F.lit(NOON))
    assert {r.id: (r.phase2_processed, r.is_duplicate) for r in out.articles.collect()} == {"a0": (True, False), "a1": (True, True), "a2": (True, None)}
    assert {r.name_en for r in out.brands.collect()} == {"BYD", "NIO"} and [r.feature_name_en for r in out.features.collect()] == ["Swap"]
    assert {r.signal_type for r in out.signals.collect()} == {"new_feature_launch", "feature_trickle_down", "chip_hardware_announcement"} and all(r.status == "pending" for r in out.signals.collect())
    assert out.article_novelty.count() == 3 and out.signal_novelty.count() == out.signals.count()


def test_models_are_retried_and_then_give_up():
    calls = []

    def flaky(prompts):
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return ["ok"] * len(prompts)

    assert models.with_retries(flaky, ["p"], pause=0) == ["ok"] and len(calls) == 3
    assert models.with_retries(lambda p: 1 / 0, ["p", "q"], pause=0) == [None, None]


# --- pages


def scrape(spark, source, html, url="https://www.x.com/explore/0123456789abcdef01"):
    return web.scrape_articles(spark.createDataFrame([(url, html)], "url string, html string"), source, F.lit(NOON)).first()


def test_meta_dates_and_chrome(spark):
    page = '<html><head><meta property="article:published_time" content="2026-07-09T08:00:00+08:00"><script>no()</script></head><body><h1> A <b>title</b></h1><div class="entry-content x"><p>One</p><div class="subscription-container">Buy</div><p>Two</p></div></body></html>'
    row = scrape(spark, "cnevpost", page)
    assert (row.title, row.body, row.publish_date, row.language) == ("A title", "One\nTwo", datetime(2026, 7, 9), "en")
    assert scrape(spark, "gasgoo", page) is None and scrape(spark, "gasgoo", None) is None and scrape(spark, "gasgoo", "") is None


def test_fallback_chains(spark):
    row = scrape(spark, "baidu_news", '<meta property="og:title" content=" T "><div><p>short</p></div><section><p>a longer one</p><p>x</p></section><footer>2026年7月9日 14:34</footer>')
    assert (row.title, row.body, row.publish_date) == ("T", "a longer one\nx", datetime(2026, 7, 9, 6, 34))


def test_embedded_state_comes_first(spark):
    row = scrape(spark, "autohome", '<title>Page</title><script id="__NEXT_DATA__">{"props": {"pageProps": {"articleContent": {"title": "J", "content": "<p>b1</p><img><p>b2</p>", "publishDate": "2026-07-18 20:13:23"}}}}</script>')
    assert (row.title, row.body, row.publish_date) == ("J", "b1\nb2", datetime(2026, 7, 18, 12, 13, 23))
    row = scrape(spark, "36kr", '<h1>D</h1><script>window.initialState={"articleDetail": {"articleDetailData": {"data": {"widgetTitle": "W", "widgetContent": "<p>c</p>", "publishTime": 1783684800999}}}};window.x={}</script>')
    assert (row.title, row.body, row.publish_date) == ("W", "c", EPOCH)
    row = scrape(spark, "xiaohongshu", '<script>window.__INITIAL_STATE__={"note": {"noteDetailMap": {"0123456789abcdef01": {"note": {"title": "", "desc": "first\\nsecond", "time": 1783684800000, "x": undefined}}}}}</script>')
    assert (row.title, row.body, row.publish_date) == ("first", "first\nsecond", EPOCH)
    row = scrape(spark, "dongchedi", '<script id="__NEXT_DATA__">{broken</script><h1>H</h1><article id="article"><p>p1</p><p> </p><p>p2</p></article><span class="time">2026-07-09 08:00</span>')
    assert (row.title, row.body, row.publish_date) == ("H", "p1\np2", datetime(2026, 7, 9))


def test_feeds_links_and_urls(spark):
    xml = "<rss><channel><item><title><![CDATA[A & B]]></title><link>https://x.org/1</link><pubDate>Fri, 10 Jul 2026 04:05:06 GMT</pubDate></item><item><title>C</title><link>https://x.org/2</link></item></channel></rss>"
    got = web.feed_entries(spark.createDataFrame([(xml,), ("<broken",)], "xml string")).collect()
    assert [(r.url, r.title, r.publish_date) for r in got] == [("https://x.org/1", "A & B", datetime(2026, 7, 10, 4, 5, 6)), ("https://x.org/2", "C", None)]
    url = lambda h: one(spark, web.same_site_url(F.lit(h), "https://www.x.com", "x.com"))
    assert [url(h) for h in ("//www.x.com/a#f", "/b", "https://y.org/c", "#top", "mailto:x.com")] == ["https://www.x.com/a", "https://www.x.com/b", None, None, None]
    assert one(spark, web.is_ev_related(F.lit("My new Model Y"))) and not one(spark, web.is_ev_related(F.lit("Cake")))
    page = spark.createDataFrame([('<script><a href="no">n</a></script><a class=x href="/p/1"> One <b>x</b></a>',)], "html string")
    assert [(r.href, r.title) for r in web.links(page).collect()] == [("/p/1", "One x")]


def found(spark, source, html, url="https://l.org/"):
    from tidewell.operators import listings

    rows = listings.discover(spark.createDataFrame([(url, html)], "url string, html string"), source, F.lit(NOON)).orderBy("ord").collect()
    return [(r.source_url, r.title, r.publish_date) for r in rows]


def test_listings(spark):
    page = '<div class="result"><h3><a href="https://a.org/1">One</a></h3><p class="c-author">Paper 3小时前</p></div><div class="result-op" tpl="news-normal"><h3><a href="http://a.org/2">Two</a></h3><span class="c-color-gray2">2026年7月9日</span></div><div class="result"><h3><a href="//in/3">No</a></h3></div><div class="result"><h3><a href="https://a.org/1">Again</a></h3></div>'
    assert found(spark, "baidu_news", page) == [("https://a.org/1", "One", datetime(2026, 7, 10, 9)), ("http://a.org/2", "Two", datetime(2026, 7, 8, 16))]
    page = '<ul class="article"><li data-artidanchor="1"><a href="//www.autohome.com.cn/news/1.html#pv"><h3>A</h3></a><span class="fn-left">昨天</span></li><li><a href="/ad"><h3>Ad</h3></a></li><li data-artidanchor="2"><a href="/news/2.html"></a></li></ul>'
    assert found(spark, "autohome", page) == [("https://www.autohome.com.cn/news/1.html", "A", datetime(2026, 7, 9, 12))]
    page = '<script>window.initialState={"information": {"informationList": {"itemList": [{"route": "detail_article?x", "itemId": 7, "templateMaterial": {"widgetTitle": "K", "publishTime": 1783684800123}}, {"route": "detail_video", "itemId": 8}, {"route": "detail_article", "itemId": "9"}]}}}</script><a class="article-item-title" href="/p/5">DOM</a>'
    assert found(spark, "36kr", page) == [("https://36kr.com/p/7", "K", EPOCH)]
    assert found(spark, "36kr", page.replace("{", "(", 1)) == [("https://36kr.com/p/5", "DOM", None)]
    page = '<script id="__NEXT_DATA__">{"props": {"pageProps": {"todayNews": {"head_article": [{"gid_str": "1", "title": " T "}, {"gid_str": "2", "title": "V", "is_video": true}]}, "focusPic": [{"pic_list": [{"group_id": "3", "title": "P"}]}]}}}</script><a href="/article/1?x">dup</a><a href="https://m.x/article/4?t">D</a><a href="/article/5"><img></a>'
    assert [x[:2] for x in found(spark, "dongchedi", page)] == [("https://www.dongchedi.com/article/1", "T"), ("https://www.dongchedi.com/article/3", "P"), ("https://www.dongchedi.com/article/4", "D")]
    page = '<script>window.__INITIAL_STATE__={"feed": {"feeds": [{"id": "0123456789abcdef", "modelType": "note", "noteCard": {"displayTitle": "蔚来提车"}, "x": undefined}, {"id": "0123456789abcde0", "noteCard": {"displayTitle": "cake"}}]}}</script><section class="note-item"><a class="title" href="/explore/0123456789abcde1?xsec_token=z">Tesla road trip</a></section>'
    assert [x[:2] for x in found(spark, "xiaohongshu", page)] == [("https://www.xiaohongshu.com/explore/0123456789abcdef", "蔚来提车"), ("https://www.xiaohongshu.com/explore/0123456789abcde1", "Tesla road trip")]
    assert found(spark, "dongchedi", None) == []


def test_feed_listings_and_aliases(spark, tmp_path):
    from tidewell.operators import listings
    from tidewell.sources import config

    item = "<item><title>{0}</title><link>https://x.org/{0}</link></item>"
    feeds = spark.createDataFrame([(0, f"<rss><channel>{item.format('a')}{item.format('b')}</channel></rss>"), (1, f"<rss><channel>{item.format('b')}{item.format('c')}</channel></rss>"), (2, None)], "ord int, xml string")
    assert [r.title for r in listings.discover_feeds(feeds, "gasgoo").orderBy("ord").collect()] == ["a", "b", "c"]
    (tmp_path / "a.json").write_text('{"aliases": {"byd": "BYD"}, "brands": {"BYD": {"nameZh": "比亚迪", "parentGroup": "g", "evFocus": true}}}')
    aliases, meta = config.load_aliases(spark, str(tmp_path / "a.json"))
    assert [tuple(r) for r in aliases.collect()] == [("byd", "BYD")] and meta.first().ev_focus


def test_streams(spark, tmp_path):
    from tidewell.streaming import incremental

    schema = "ts timestamp, source_name string, kind string, source_url string"
    rows = [(NOON + timedelta(minutes=k), "a", "error" if k % 3 == 0 else "request", f"u{k % 4}") for k in range(12)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    incremental.drain(incremental.distinct_urls(stream()), str(tmp_path / "urls"), str(tmp_path / "c1"))
    assert sorted(r.source_url for r in spark.read.parquet(str(tmp_path / "urls")).collect()) == ["u0", "u1", "u2", "u3"]
    seen = []

    def fails_first(batch, n):
        seen.append(batch.count())
        if len(seen) == 1:
            raise RuntimeError("no")

    with pytest.raises(Exception, match="no"):
        incremental.drain_batches(stream(), fails_first, str(tmp_path / "c2"))
    incremental.drain_batches(stream(), fails_first, str(tmp_path / "c2"))
    incremental.drain_batches(stream(), fails_first, str(tmp_path / "c2"))
    assert seen == [12, 12]
