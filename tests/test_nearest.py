"""The greatest similarity with any other, against brute force, and what it shuffles."""

import random

import pytest

from tidewell.operators import novelty

ARTICLES = "id string, title_en string, brands_mentioned array<string>, vehicles_mentioned array<string>, features_extracted array<struct<category:string>>, content_type string, duplicate_group_id string"
SIGNALS = "id string, signal_type string, brands_mentioned array<string>, features_mentioned array<string>, source_article_ids array<string>"


def _jaccard(x, y):
    x, y = set(x or ()), set(y or ())
    return len(x & y) / len(x | y) if x | y else 0.0


def _some(rand, letter, n, sizes):
    return list(dict.fromkeys(rand.choices([f"{letter}{i}" for i in range(n)], [1 / (i + 1) for i in range(n)], k=rand.choice(sizes))))


def _articles(rand, name, n):
    def one(i):
        kinds = rand.sample(novelty.CATEGORIES[:3], rand.choice([0, 1, 1, 2]))
        return f"{name}{i}", None, _some(rand, "b", 60, [0, 1, 2, 5, 12]), _some(rand, "v", 60, [0, 1, 3, 9]), [(k,) for k in kinds], rand.choice(["x", "y", "", None]), rand.choice(["g", "h"]) if i % 5 == 0 else None

    out = [one(i) for i in range(n)]
    return out + [(f"{name}c{i}", *out[i][1:]) for i in range(0, n, 9)]


def _alike(x, y):
    content = [[*r[3], *(c for (c,) in r[4])] for r in (x, y)]
    same = x[5] and x[5] == y[5] and x[2] and y[2] and x[2][0] == y[2][0]
    return 0.25 * _jaccard(x[2], y[2]) + 0.25 * _jaccard(*content) + 0.15 * bool(same)


@pytest.mark.parametrize(("common", "other_recent"), [(7, False), (20, True), (512, False)])
def test_article_set_novelty_equals_brute_force(spark, common, other_recent):
    """All terms rare but the categories, some of them, none; other articles of the own group are left out."""
    rand = random.Random(5)
    mine = _articles(rand, "a", 120)
    theirs = mine[:40] + _articles(rand, "b", 80) if other_recent else mine
    want = {x[0]: 1 - max(_alike(x, y) for y in theirs if x[0] != y[0] and not (x[6] and x[6] == y[6])) for x in mine}
    a = spark.createDataFrame(mine, ARTICLES)
    got = {r.id: r.novelty for r in novelty.article_set_novelty(a, spark.createDataFrame(theirs, ARTICLES) if other_recent else a, common).collect()}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want)


def _shuffled(spark, run):
    """Rows that the stages of ``run`` write for others."""
    sc = spark.sparkContext._jsc.sc()

    def total():
        sc.listenerBus().waitUntilEmpty(30_000)
        stages = sc.statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    before = total()
    run()
    return total() - before


def test_pairs_of_articles_are_not_shuffled(spark):
    """A thousand articles that all have a brand in common make a million pairs."""
    rows = [(f"i{i}", None, ["all", f"own{i % 400}"], [f"v{i}"], [("ota",)], "x", None) for i in range(1000)]
    a = spark.createDataFrame(rows, ARTICLES)
    assert _shuffled(spark, lambda: novelty.article_set_novelty(a, a).collect()) < 100_000


@pytest.mark.parametrize(("common", "other_recent"), [(6, False), (30, True)])
def test_signal_novelty_equals_brute_force_whatever_is_common(spark, common, other_recent):
    rand = random.Random(9)
    one = lambda name: (name, rand.choice(["k1", "k1", "k2", "", None]), _some(rand, "b", 60, [0, 1, 2, 5, 12]), _some(rand, "f", 15, [0, 1, 1, 3]), [f"s{rand.randrange(60)}"])
    mine = [one(f"a{i}") for i in range(120)]
    mine += [(f"c{i}", *mine[i][1:]) for i in range(12)]
    theirs = mine[:40] + [one(f"b{i}") for i in range(80)] if other_recent else mine
    alike = lambda x, y: 0.3 * bool(x[1] and x[1] == y[1]) + 0.35 * _jaccard(x[2], y[2]) + 0.2 * _jaccard(x[3], y[3]) + 0.15 * _jaccard(x[4], y[4])
    want = {x[0]: 1 - min(1, max(alike(x, y) for y in theirs if y[0] != x[0])) for x in mine}
    a = spark.createDataFrame(mine, SIGNALS)
    got = {r.id: r.novelty for r in novelty.signal_novelty(a, spark.createDataFrame(theirs, SIGNALS) if other_recent else a, common).collect()}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want)


def test_pairs_of_signals_are_not_shuffled(spark):
    """A thousand signals without a type, so that nothing but a brand that all have is in common, make a million pairs."""
    rows = [(f"i{i}", None, ["all", f"own{i}"], [], [f"s{i}"]) for i in range(1000)]
    a = spark.createDataFrame(rows, SIGNALS)
    assert _shuffled(spark, lambda: novelty.signal_novelty(a, a).collect()) < 100_000
