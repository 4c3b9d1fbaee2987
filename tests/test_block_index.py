"""The stored blocking index: runs that compare their batch only, against one comparison of all articles."""

import re

import pytest
from pyspark.sql import functions as F

from tidewell.operators import block_index, components, dedup
from tidewell.plans import fixtures
from tidewell.sources import snapshots

from .test_kernels import NOON, article, make  # noqa: F401

SF = "/root/testdata/sf0.001"


def _found(pairs):
    return sorted((r.a, r.b, round(r.score, 9)) for r in pairs.select("a", "b", "score").collect())


def _index(spark, tmp_path, **more):
    return block_index.BlockIndex(snapshots.RunStore(spark, f"file://{tmp_path}"), **{"buckets": 4, "parts": 2} | more)


def test_runs_find_the_pairs_and_components_of_all_articles(spark, tmp_path):
    rows = fixtures.articles(spark, SF)
    every = dedup.scored_pairs(rows, 0.6).cache()
    index = _index(spark, tmp_path, threshold=0.6)
    for run in (2, 0, 1):
        block_index.duplicate_run(index, f"run {run}", rows.where(F.col("ord") % 3 == run), buckets=4)
        if run == 2:  # a run that dies after its files leaves nothing that counts
            index.add(index.store.snapshot(), dedup.prepare(rows.where(F.col("ord") % 3 == 0)))
        if run == 0:  # another session knows no table
            for table in spark.catalog.listTables():
                if table.name.startswith("tidewell_"):
                    spark.sql(f"DROP TABLE {table.name}")
    want = _found(every)
    assert want and _found(index.store.read("pairs")) == want
    now = components.Components(index.store.read("labels"), index.store.read("merges")).resolved()
    assert sorted(now.collect()) == sorted(components.connected_components(every, "a_ord", "b_ord").collect())

    version = index.store.snapshot().version
    assert block_index.duplicate_run(index, "run 1", rows, buckets=4).version == version
    block_index.duplicate_run(index, "again", rows.where("ord < 200").unionByName(rows.where("ord < 100")), buckets=4)
    assert _found(index.store.read("pairs")) == want


def test_the_index_is_joined_where_it_lies(spark, tmp_path):
    rows = fixtures.articles(spark, SF)
    index = _index(spark, tmp_path)
    block_index.duplicate_run(index, "first", rows.where("ord % 4 <> 0"), buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = index.store.snapshot()
        added, batch = index.add(base, dedup.prepare(rows.where("ord % 4 = 0")))
        plan = index.pairs(base, added, batch)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    depth = lambda line: re.search(r"[A-Za-z(*]", line).start()
    scans = [n for n, line in enumerate(lines) if "FileScan" in line and re.search("tidewell_(postings|sets|titles)_", line)]
    assert len(scans) == 5
    for n in scans:
        above, at = [], depth(lines[n])
        for line in reversed(lines[:n]):
            if line.strip() and depth(line) < at:
                above.append(line)
                at = depth(line)
        until = next(i for i, line in enumerate(above) if "Join" in line)
        assert not any("Exchange" in line for line in above[:until]), plan


def test_only_attempts_near_in_time_are_read(spark, make, tmp_path):  # noqa: F811
    index, far = _index(spark, tmp_path), NOON.replace(year=NOON.year + 1)
    for run, when in (("near", NOON), ("far", far)):
        block_index.duplicate_run(index, run, make(article(1 if run == "near" else 3, publish_date=when)), buckets=4)
    base = index.store.snapshot()
    added, batch = index.add(base, dedup.prepare(make(article(2))))
    assert len(index._attempts(base, added.low, added.high)) == 1
    assert [(r.a, r.b) for r in index.pairs(base, added, batch).collect()] == [("a1", "a2")]


@pytest.mark.parametrize("crowd", [1000, 1])
def test_candidates_are_the_hopeful_pairs_and_little_is_asked(spark, tmp_path, crowd):
    rows = fixtures.articles(spark, SF)
    index = _index(spark, tmp_path, crowd=crowd)
    block_index.duplicate_run(index, "first", rows.where("ord % 4 <> 0"), buckets=4)
    base = index.store.snapshot()
    added, batch = index.add(base, dedup.prepare(rows.where("ord % 4 = 0")))
    every = dedup.prepare(rows).cache()
    late = (F.col("a.ord") % 4 == 0) | (F.col("b.ord") % 4 == 0)
    ids = lambda pairs: sorted(tuple(r) for r in pairs.select("a.ord", "b.ord").collect())
    assert ids(index.candidates(base, added, batch)) == ids(dedup.hopeful_pairs(every).where(late))
    parts = set(index._near(base, added).values())
    assert parts == ({1} if crowd == 1000 else {2})
    assert index._asked(batch, max(parts)).count() < 2 * max(parts) * index._postings(batch).count()


@pytest.mark.parametrize("rows", [(), ({"publish_date": None, "scrape_date": None},), ({"brands_mentioned": None, "vehicles_mentioned": None},), ({"title_en": None, "source_name": None},)])
def test_batches_without_pairs(spark, make, tmp_path, rows):  # noqa: F811
    index = _index(spark, tmp_path)
    batch = make(*(article(i, **r) for r in rows for i in (1, 2)))
    assert block_index.duplicate_run(index, "one", batch, buckets=4).version == 1
    assert index.store.read("pairs").count() == 0


def test_of_two_runs_at_once_the_later_is_refused(spark, make, tmp_path, monkeypatch):  # noqa: F811
    index, second = _index(spark, tmp_path), _index(spark, tmp_path)
    commit, met = index.store.commit, []

    def late(base, run, written):
        if not met:
            met.append(block_index.duplicate_run(second, "faster", make(article(2)), buckets=4))
        return commit(base, run, written)

    monkeypatch.setattr(index.store, "commit", late)
    with pytest.raises(snapshots.Conflict):
        block_index.duplicate_run(index, "slower", make(article(1)), buckets=4)
    block_index.duplicate_run(index, "slower", make(article(1)), buckets=4)
    assert [(r.a, r.b) for r in index.store.read("pairs").collect()] == [("a1", "a2")]
