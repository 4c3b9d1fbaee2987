"""Whole runs, done twice and failing half-way; duplicates and novelty against brute force on the tables."""

import random
import re
from datetime import timedelta
from difflib import SequenceMatcher
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidewell import tables
from tidewell.functions import text
from tidewell.operators import components, dedup, entities, listings, novelty, signals, web
from tidewell.plans import corpus_queries, fixtures, pipelines
from tidewell.plans.store_queries import maker_model
from tidewell.sources import snapshots

from .test_kernels import NOON, article, make, other  # noqa: F401

SF = "/root/testdata/sf0.001"
ALIASES = [("byd", "BYD"), ("nio", "NIO")]


def _jaccard(a, b):
    a, b = set(a or ()), set(b or ())
    return len(a & b) / len(a | b) if a | b else 0.0


def _ratio(a, b):
    return SequenceMatcher(None, a.lower(), b.lower()).ratio() if a and b else 0.0


@pytest.fixture(scope="module")
def rows(spark):
    return fixtures.articles(spark, SF)


@pytest.mark.parametrize("threshold", [0.6, 0.5])
def test_pairs_equal_brute_force_on_the_table(rows, threshold):
    got = {(r.a, r.b): r.score for r in dedup.scored_pairs(rows, threshold=threshold).collect()}
    every, want, alone = sorted(rows.collect(), key=lambda r: r.ord), {}, 0
    for i, x in enumerate(every):
        for y in every[i + 1 :]:
            at = [r.publish_date or r.scrape_date for r in (x, y)]
            if x.source_name == y.source_name or abs(at[0] - at[1]) > timedelta(hours=72):
                continue
            sets = 0.25 * _jaccard(x.brands_mentioned, y.brands_mentioned) + 0.2 * _jaccard(x.vehicles_mentioned, y.vehicles_mentioned) + 0.15 * (x.category == y.category) + 0.1
            if sets + 0.3 >= threshold - 1e-9 and (score := sets + 0.3 * _ratio(x.title_en, y.title_en)) >= threshold - 1e-9:
                want[x.id, y.id] = score
                alone += not (set(x.brands_mentioned) & set(y.brands_mentioned) or set(x.vehicles_mentioned) & set(y.vehicles_mentioned))
    assert len(want) >= 15 and set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want)
    assert bool(alone) == (threshold < 0.55)


def test_set_scores_equal_brute_force_on_the_table(rows):
    got = {(r.a, r.b): r.score for r in dedup.set_score_pairs(rows, 24).collect()}
    every, want = sorted(rows.collect(), key=lambda r: r.ord), {}
    for i, x in enumerate(every):
        for y in every[i + 1 :]:
            near = abs((x.publish_date or x.scrape_date) - (y.publish_date or y.scrape_date)) <= timedelta(hours=24)
            if x.source_name != y.source_name and near and (set(x.brands_mentioned) & set(y.brands_mentioned) or set(x.vehicles_mentioned) & set(y.vehicles_mentioned)):
                want[x.id, y.id] = 0.25 * _jaccard(x.brands_mentioned, y.brands_mentioned) + 0.2 * _jaccard(x.vehicles_mentioned, y.vehicles_mentioned) + 0.15 * (x.category == y.category) + 0.1
    assert len(want) > 20 and set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want)


@pytest.mark.parametrize("pairs", [lambda rows: dedup.hopeful_pairs(dedup.prepare(rows)), dedup.set_score_pairs])
def test_no_set_is_shuffled_for_each_of_its_members(spark, rows, pairs):
    """Rows that meet on a key hold numbers, a source and a time: with the article's sets they grew with the square of its length."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = spark._jvm.PythonSQLUtils.explainString(pairs(rows)._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sides = [re.findall(r"(\w+)#\d+", m[1]) for m in re.finditer(r"\) Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning\(key#", plan)]
    assert len(sides) == 2 and all(re.fullmatch("key|met|[xy]_(span|ord|source|at|n_brands|n_vehicles)", c) for side in sides for c in side)


def test_two_runs_store_no_texts(spark):
    n = len(tables._made)
    corpus_queries.dedup_two_runs(spark, SF)
    stored = [p for p in tables._made[n:] if "-first-run-" in p or "-second-run-" in p]
    assert len(stored) == 2
    for path in stored:
        got = spark.read.parquet(path)
        assert "body_en" not in got.columns and got.where("exists(features_extracted, f -> f.description IS NOT NULL)").isEmpty()


def test_the_bound_of_a_title_is_never_under_its_ratio(spark):
    rng = random.Random(8)
    titles = ["".join(rng.choice("abAB éÉüß漢字 x") for _ in range(rng.randint(0, 14))) for _ in range(60)] + ["", "İstanbul ΑΣ", None]
    pairs = spark.createDataFrame([(rng.choice(titles), rng.choice(titles)) for _ in range(600)], "a string, b string")
    got = pairs.select("a", "b", text.title_bound(text.letters(F.col("a")), text.letters(F.col("b"))).alias("bound")).collect()
    assert all(r.bound >= _ratio(r.a, r.b) - 1e-9 for r in got) and sum(r.bound < 0.5 for r in got) > 100


def test_thresholds_that_time_alone_reaches_are_refused(rows):
    with pytest.raises(ValueError, match="in common"):
        dedup.scored_pairs(rows, threshold=0.4)


def _novelties(batch, recent):
    out = {}
    for x in batch:
        best = 0.0
        for y in recent:
            if x.id == y.id or x.duplicate_group_id and x.duplicate_group_id == y.duplicate_group_id:
                continue
            same = x.content_type == y.content_type and x.brands_mentioned and y.brands_mentioned and x.brands_mentioned[0] == y.brands_mentioned[0]
            content = [[*r.vehicles_mentioned, r.category] for r in (x, y)]
            best = max(best, 0.35 * _ratio(x.title_en, y.title_en) + 0.25 * _jaccard(x.brands_mentioned, y.brands_mentioned) + 0.25 * _jaccard(*content) + 0.15 * bool(same))
        out[x.id] = 1 - best
    return out


def test_novelty_of_batches_of_any_size_equals_brute_force(rows, monkeypatch):
    some = rows.where("ord < 70").withColumn("duplicate_group_id", F.when(F.col("ord") % 9 == 0, "g"))
    batch = some.where("ord % 3 = 0")
    want = _novelties(batch.collect(), some.collect())
    for size in (1000, 7):
        monkeypatch.setattr(novelty, "BATCH", size)
        got = {r.id: r.novelty for r in novelty.article_novelty(batch, some).collect()}
        assert set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want)


def test_set_novelty_leaves_out_the_own_group(rows):
    some = rows.where("ord < 120").withColumn("duplicate_group_id", F.when(F.col("ord") % 4 == 0, "g")).withColumn("title_en", F.lit(None).cast("string"))
    want = _novelties(some.collect(), some.collect())
    got = {r.id: r.novelty for r in novelty.article_set_novelty(some, some).collect()}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want)


SIGNALS = "id string, signal_type string, brands_mentioned array<string>, features_mentioned array<string>, source_article_ids array<string>"


@pytest.mark.parametrize("other_recent", [False, True])
def test_signal_novelty_equals_brute_force(spark, monkeypatch, other_recent):
    """Brands of all frequencies, common ones asked for by size, ids that come again with other sets, types that are missing."""
    monkeypatch.setattr(novelty, "COMMON", 4)
    some, brands = random.Random(7), [f"b{i}" for i in range(50)]

    def signal(name):
        named = list(dict.fromkeys(some.choices(brands, [1 / (i + 1) for i in range(50)], k=some.choice([1, 2, 3, 5, 8, 20])))) if some.random() < 0.9 else None
        return name, some.choice(["k1", "k1", "k2", "", None]), named, [f"f{some.randrange(12)}" for _ in range(some.choice([0, 1, 1, 3]))], [f"s{some.randrange(100)}"]

    mine = [signal(f"a{i}") for i in range(100)]
    mine += [(f"c{i}", *mine[i][1:]) for i in range(15)]
    theirs = [signal(f"a{i}") for i in range(60)] + [signal(f"b{i}") for i in range(60)] if other_recent else mine
    alike = lambda x, y: 0.3 * bool(x[1] and x[1] == y[1]) + 0.35 * _jaccard(x[2], y[2]) + 0.2 * _jaccard(x[3], y[3]) + 0.15 * _jaccard(x[4], y[4])
    want = {x[0]: 1 - min(1, max(alike(x, y) for y in theirs if y[0] != x[0])) for x in mine}
    a = spark.createDataFrame(mine, SIGNALS)
    got = {r.id: r.novelty for r in novelty.signal_novelty(a, spark.createDataFrame(theirs, SIGNALS) if other_recent else a).collect()}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want)


def test_a_brand_that_all_signals_have_makes_no_pairs(spark):
    """A thousand signals with one brand in common and one of their own: as they have floors, no two of them are compared."""
    rows = [(f"i{i}", "k", ["all", f"own{i}"], [], [f"s{i}"]) for i in range(1000)]
    a = spark.createDataFrame(rows, SIGNALS).select("id", F.col("signal_type").alias("kind"), F.col("brands_mentioned").alias("brands"), F.col("features_mentioned").alias("features"), F.col("id").alias("form"))
    units = novelty._units(a)
    held = novelty._ordered(units, units.select(F.explode("brands").alias("brand")).groupBy("brand").agg(F.count("*").alias("held")).withColumn("term", F.monotonically_increasing_id()))
    asked = held.join(novelty._floors(held, held), "unit")
    assert novelty._rivals(asked, held).where("unit <> other").count() == 0
    assert [r[0] for r in novelty.signal_novelty(spark.createDataFrame(rows, SIGNALS), spark.createDataFrame(rows, SIGNALS)).select(F.round("novelty", 6)).distinct().collect()] == [pytest.approx(round(1 - 0.3 - 0.35 / 3, 6))]


def test_matches_of_a_rule_are_counted_before_they_meet(spark, make):  # noqa: F811
    feature = lambda name, at, new=True: (name, at, None, None, new)
    some = make(article(0, features_extracted=[feature("x", "ota"), feature("y", "ota"), feature("z", "adas"), feature("w", "adas", False)]), article(1, features_extracted=[feature("x", "ota")], brands_mentioned=["nio"]))
    known = spark.createDataFrame([("NIO", "ota", "f"), ("NIO", "ota", "f"), ("NIO", "adas", "f"), ("NIO", "adas", None), ("BYD", "ota", "f"), ("", "ota", "f")], "brand_name_en string, category string, feature_name_en string")
    got = signals.trickle_down_totals(some, known)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1  # the articles; no match
    assert {tuple(r) for r in got.collect()} == {("a0", "NIO", "f", 5), ("a0", "NIO", None, 1), ("a1", "BYD", "f", 1)}
    matches = signals.trickle_down_matches(some, known).groupBy("id", "existing_brand", "existing_feature").agg(F.count("*").alias("n"))
    assert {tuple(r) for r in matches.collect()} == {tuple(r) for r in got.collect()}


def test_set_novelty_sends_no_terms_to_all_tasks(rows):
    plan = novelty.article_set_novelty(rows, rows)._jdf.queryExecution().executedPlan().toString()
    joins = re.findall(r"(\w+Join)\w*,? \[(term)#", plan)
    assert joins == [("SortMergeJoin", "term")] and "array_intersect(a" not in re.search(r"SortMergeJoin \[term#.*", plan)[0]


def _second_phase(spark, articles, as_of, signals=None):
    known = spark.createDataFrame([("BYD", "adas", "Pilot", None, "1")], "brand_name_en string, category string, feature_name_en string, first_seen_date timestamp, id string")
    aliases, meta = spark.createDataFrame(ALIASES, "alias string, canonical string"), spark.createDataFrame([("BYD", "g"), ("NIO", "g")], "name_en string, parent_group string")
    old = signals if signals is not None else spark.createDataFrame([], "id string, signal_type string, brands_mentioned array<string>, features_mentioned array<string>, source_article_ids array<string>, created_date timestamp")
    return pipelines.second_phase(articles, known, aliases, meta, old, F.lit(as_of))


def test_late_members_join_the_group_of_an_earlier_run(spark, make, tmp_path):  # noqa: F811
    first = _second_phase(spark, make(article(0), article(1), other(5)), NOON + timedelta(hours=9))
    done = {r.id: r for r in first.articles.collect()}
    assert (done["a0"].is_duplicate, done["a1"].is_duplicate, done["a1"].canonical_article_id, done["a5"].is_duplicate) == (False, True, "a0", None) and all(r.phase2_processed for r in done.values())
    late = make(article(2)).withColumn("canonical_article_id", F.lit(None).cast("string"))
    again = {r.id: r for r in _second_phase(spark, first.articles.unionByName(late, allowMissingColumns=True), NOON + timedelta(hours=20)).articles.collect()}
    assert (again["a2"].is_duplicate, again["a2"].canonical_article_id, again["a2"].duplicate_group_id) == (True, "a0", done["a0"].duplicate_group_id)
    assert again["a0"].is_duplicate is False and again["a1"].canonical_article_id == "a0" and again["a5"].canonical_article_id is None
    once_more = {r.id: r for r in _second_phase(spark, spark.createDataFrame(list(again.values()), first.articles.schema), NOON + timedelta(hours=30)).articles.collect()}
    assert {k: r.canonical_article_id for k, r in once_more.items()} == {k: r.canonical_article_id for k, r in again.items()}


def test_novelty_with_or_without_the_groups_of_the_run(spark, make):  # noqa: F811
    articles = make(article(0), article(1))
    both = {}
    for known in (True, False):
        out = pipelines.second_phase(
            articles, spark.createDataFrame([], "brand_name_en string, category string, feature_name_en string"), spark.createDataFrame(ALIASES, "alias string, canonical string"), spark.createDataFrame([("BYD", "g")], "name_en string, parent_group string"),
            spark.createDataFrame([], "id string, signal_type string, brands_mentioned array<string>, features_mentioned array<string>, source_article_ids array<string>"), F.lit(NOON), groups_in_novelty=known,
        )
        both[known] = {r.id: r.novelty for r in out.article_novelty.collect()}
    assert both == {True: {"a0": 1.0, "a1": 1.0}, False: {"a0": pytest.approx(0.0), "a1": pytest.approx(0.0)}}


def _two_articles(make):  # noqa: F811
    return make(article(0, vehicles_mentioned=["BYD Seal", "Nobody X"], features_extracted=[("City pilot", "adas", "Orin chip", None, True)]), other(5, vehicles_mentioned=["NIO ET5"]))


def test_a_commit_that_dies_anywhere_counts_once_when_done_again(spark, make, tmp_path, monkeypatch):  # noqa: F811
    articles = _two_articles(make)
    done = _second_phase(spark, articles, NOON)
    assert {r.model_name_en: r.brand_name_en for r in done.vehicles.collect()} == {"Seal": "BYD", "ET5": "NIO"}
    assert {(r.id, r.brands_promoted, r.vehicles_promoted, r.features_promoted) for r in done.promoted.collect()} == {("a0", 1, 1, 1), ("a5", 1, 1, 1)}
    assert {(r.feature_name_en, r.vehicle_model_name) for r in done.features.collect()} == {("City pilot", "Seal"), ("Swap", "ET5")}
    into = snapshots.RunStore(spark, f"file://{tmp_path}")
    commit = lambda base: pipelines.commit_phase2(done, articles, into, base, "run", F.lit(NOON), buckets=4)
    write, calls = snapshots.RunStore.upsert, []

    def dies(self, base, name, *args, **rules):
        if len(calls) == fatal:
            raise OSError("no space")
        calls.append(name)
        return write(self, base, name, *args, **rules)

    monkeypatch.setattr(snapshots.RunStore, "upsert", dies)
    for fatal in range(5):
        calls.clear()
        with pytest.raises(OSError, match="no space"):
            commit(into.snapshot())
        assert into.snapshot().version == 0
    fatal = 99
    with monkeypatch.context() as patch:  # all is written, but the manifest
        patch.setattr(snapshots.RunStore, "_publish", lambda self, made: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError, match="gone"):
            commit(into.snapshot())
    assert into.snapshot().version == 0 and into.versions() == []
    made = commit(into.snapshot())
    assert made.version == 1 and commit(made).version == 1 and commit(snapshots.Snapshot(0, None, {})).version == 1
    counts = {n: into.read(n).count() for n in made.tables}
    assert counts == {"brands": 2, "vehicles": 2, "features": 2, "signals": done.signals.count(), "articles": 2}
    assert into.read("articles").where("phase2_processed").count() == 2 and {r.last_updated for r in into.read("features").collect()} == {NOON}
    folders = len([p for p in (tmp_path / "data").glob("*/*") if p.is_dir()])
    assert into.remove_orphans(older_than=0.0) == folders - sum(bool(t.files) for t in made.tables.values())
    assert {n: into.read(n).count() for n in made.tables} == counts


def test_two_runs_at_once(spark, tmp_path):
    into = snapshots.RunStore(spark, f"file://{tmp_path}")
    rows = lambda *pairs: spark.createDataFrame(pairs, "k string, v int")
    first = into.commit(into.snapshot(), "first", {"t": into.upsert(into.snapshot(), "t", rows(*((f"k{i}", i) for i in range(40))), ["k"], buckets=8)})
    a, b, c = (into.upsert(first, "t", rows((k, v)), ["k"]) for k, v in (("k1", 100), ("k1", 200), ("k2", 300)))
    bucket = {r.k: r.b for r in rows(("k1", 0), ("k2", 0)).select("k", snapshots._bucket(["k"], 8).alias("b")).collect()}
    assert bucket["k1"] != bucket["k2"] and {x for x in a.files if a.files[x] != first.tables["t"].files[x]} == {bucket["k1"]}
    assert into.commit(first, "a", {"t": a}).version == 2
    with pytest.raises(snapshots.Conflict):
        into.commit(first, "b", {"t": b})
    assert into.commit(first, "c", {"t": c}).version == 3  # another bucket: on top of the other run
    again = into.snapshot()
    into.commit(again, "b", {"t": into.upsert(again, "t", rows(("k1", 200), (None, 1)), ["k"])})
    got = {r.k: r.v for r in into.read("t").collect()}
    assert got == {f"k{i}": i for i in range(40)} | {"k1": 200, "k2": 300, None: 1} and {r.k: r.v for r in into.read("t", first).collect()} == {f"k{i}": i for i in range(40)}
    last = into.snapshot()
    made = snapshots.Snapshot(last.version + 1, "x", last.tables)
    assert into._publish(made) and not into._publish(made)  # a version comes into place once


def test_columns_of_later_runs_and_tables_without_rows(spark, tmp_path):
    into = snapshots.RunStore(spark, f"file://{tmp_path}")
    none = spark.createDataFrame([], "k long, v string")
    into.commit(into.snapshot(), "empty", {"t": into.upsert(into.snapshot(), "t", none, ["k"], buckets=4)})
    assert into.read("t").columns == ["k", "v"] and into.read("t").count() == 0
    for run, rows in (("one", spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")), ("two", spark.createDataFrame([(2, 5)], "k int, more int"))):
        base = into.snapshot()
        into.commit(base, run, {"t": into.upsert(base, "t", rows, ["k"], keep_known=["v"])})
    assert sorted((r.k, r.v, r.more) for r in into.read("t").collect()) == [(1, "a", None), (2, "b", 5)]
    with pytest.raises(ValueError, match="dealt"):
        into.upsert(into.snapshot(), "t", none, ["v"])


def test_features_keep_their_link_and_differ_by_category(spark, make):  # noqa: F811
    pilot = lambda c, d: ("Pilot", c, d, None, True)
    rows = make(
        article(0, vehicles_mentioned=["BYD Seal"], features_extracted=[pilot("adas", "d0"), pilot("ota", "d1"), pilot("adas", "d2")]),
        article(1, vehicles_mentioned=None, features_extracted=[pilot("adas", "d3")], scrape_date=NOON - timedelta(days=1)),
    )
    aliases = spark.createDataFrame(ALIASES, "alias string, canonical string")
    made = entities.promote_entities(rows, aliases, spark.createDataFrame([], "name_en string, parent_group string"))
    got = {(r.category, r.description, r.vehicle_model_name, r.first_seen_date) for r in made.features.collect()}
    assert got == {("adas", "d3", "Seal", NOON - timedelta(days=1)), ("ota", "d1", "Seal", NOON)}  # the older article is written last, and has no vehicle
    assert {r.id: r.features_promoted for r in made.counts.collect()} == {"a0": 3, "a1": 1}


@pytest.mark.parametrize("batches", [1, 2, 7])
def test_components_of_batches_are_those_of_all_edges(spark, batches):
    rng = random.Random(batches)
    pairs = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(200 + i, 201 + i) for i in range(12)] + [(5, 5), (None, 3), (300, 300)]
    rng.shuffle(pairs)
    edges = lambda part: spark.createDataFrame(part, "a long, b long")
    state = components.no_components(spark)
    for k in range(batches):
        added = components.with_edges(state, edges(pairs[k::batches]))
        assert added.labels.join(state.labels, "id", "left_semi").count() == 0  # labels are never rewritten
        moved = {r.component: r.root for r in state.merges.collect()} | {r.component: r.root for r in added.merges.collect()}
        state = components.Components(state.labels.unionByName(added.labels), spark.createDataFrame(list(moved.items()), "component long, root long"))
    want = {r.id: r.component for r in components.connected_components(edges(pairs)).collect()}
    assert {r.id: r.component for r in state.resolved().collect()} == want and len(set(want.values())) > 5


def test_triage_only_rows_keep_what_they_had(spark, make):  # noqa: F811
    rows = make(article(0), article(1), article(2))
    answers = spark.createDataFrame(
        [("a0", "triage_only", '{"headline": "h", "relevance_score": 2, "content_type": "news"}'),
         ("a1", "extracted", '{"headline": "h", "relevance_score": 8, "content_type": "news", "brands_mentioned": ["NIO"], "vehicles_mentioned": [], "features_extracted": [{"feature_name": "Swap", "category": "ota", "is_new": true, "more": 1}], "competitive_signal": null}'),
         ("a2", "error", None)], "id string, outcome string, result string",
    )
    done = {r.id: r for r in pipelines.write_back(rows, pipelines.article_update(answers)).collect()}
    assert done["a0"].brands_mentioned == ["BYD"] and done["a0"].features_extracted[0].feature_name == "City pilot" and done["a0"].triage_only and done["a0"].relevance_score == 2
    assert done["a1"].brands_mentioned == ["NIO"] and [tuple(f) for f in done["a1"].features_extracted] == [("Swap", "ota", None, None, True)] and not done["a1"].triage_only
    assert done["a2"].title_en == "BYD launches city pilot for the Seal" and done["a2"].triage_only is None


def test_answers_of_the_model_are_remembered(spark, make):  # noqa: F811
    rows = make(*(article(i, brands_mentioned=[f"Maker {i}", "BYD"]) for i in range(6)))
    aliases, asked = spark.createDataFrame(ALIASES, "alias string, canonical string"), []
    memo = entities.resolver_run(rows, aliases, None, maker_model, calls=4)
    assert {r.key: r.name_en for r in memo.collect()} == {"maker 0": "Maker 0", "maker 1": None, "maker 2": "Maker 2", "maker 3": None}
    second = entities.resolver_run(rows, aliases, memo, maker_model, calls=4)
    assert {r.key for r in second.collect()} == {f"maker {i}" for i in range(6)} and not asked
    brands = entities.promote_brands(rows, aliases, spark.createDataFrame([], "name_en string, parent_group string"), second)
    assert {r.name_en: r.n_articles for r in brands.collect()} == {"BYD": 6, "Maker 0": 1, "Maker 2": 1, "Maker 4": 1}


def test_a_bad_page_costs_its_own_row(spark):
    deep = '<script>window.initialState=' + '{"information":' * 3000 + "1" + "}" * 3000 + "</script>"
    endless = '<script>window.initialState={"information": {"informationList": {"itemList": [{"route": "detail_article", "itemId": 7, "templateMaterial": {"widgetTitle": "K", "publishTime": Infinity}}]}}}</script>'
    good = '<a class="article-item-title" href="/p/5">DOM</a>'
    pages = spark.createDataFrame([("u1", deep), ("u2", endless), ("u3", good), ("u4", None)], "url string, html string")
    found = {r.source_url: r.title for r in listings.discover(pages, "36kr", F.lit(NOON)).collect()}
    assert found == {"https://36kr.com/p/7": "K", "https://36kr.com/p/5": "DOM"}
    assert web.parsed_pages(pages, "36kr").where("parse_error IS NOT NULL").count() == 0 and web.scrape_articles(pages, "36kr", F.lit(NOON)).count() == 0


def test_stories_that_several_words_find_count_under_the_first(spark):
    page = lambda *stories: "".join(f'<div class="result"><h3><a href="https://x.org/{s}">{s} {i}</a></h3></div>' for i, s in enumerate(stories))
    words = listings.NEWS_WORDS
    pages = spark.createDataFrame([("https://a", words[3], page("s1", "s2")), ("https://b", words[0], page("s3", "s1"))], "url string, word string, html string")
    found = {r.source_url: (r.title, r.ord.turn) for r in listings.discover(pages, "baidu_news", F.lit(NOON), word_col="word").collect()}
    assert found == {"https://x.org/s1": ("s1 1", 1), "https://x.org/s2": ("s2 1", 4), "https://x.org/s3": ("s3 0", 1)}


def test_a_cluster_needs_a_shared_folder():
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master="spark://x:7077"))
    with pytest.raises(ValueError, match="checkpoint"):
        tables.shared_dir(cluster)
