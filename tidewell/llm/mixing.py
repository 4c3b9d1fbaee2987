"""Mixing sources to target weights: iterative proportional fitting of token weights with probabilities up to 1, then sampling. DataFrame functions only."""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..tables import discard, materialise

#: A marginal's default target is its token share to this power, made to sum to 1 (1 keeps the shares, 0 makes them equal).
POWERS = {"source": 0.7, "lang": 0.7, "topic": 0.5}
#: Passes between two looks at the change, passes at most unless a caller wants more, and the change of any probability in a pass at which raking has converged.
ROUNDS, MOST_ROUNDS, TOLERANCE = 5, 300, 1e-9
#: Combinations up to which one task rakes them all without a shuffle.
SMALL = 100_000
#: Tokens to sample, as a share of all tokens.
KEEP = 0.7
DIMS = ("source", "lang", "topic")


def n_words(text: Column) -> Column:
    """White-space separated words, as the measure of tokens."""
    return F.regexp_count(text, F.lit(r"\S+")).cast("long")


def topic_by_form(words: Column) -> Column:
    """Stand-in topic for tables without one: what kind of piece a text is by its length."""
    return F.when(words < 100, "note").when(words < 1000, "article").otherwise("longread")


def default_target(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """The dim and ``share`` for each of its values: token share to ``power``."""
    of = cells.where("tokens > 0").groupBy(dim).agg(F.sum("tokens").cast("double").alias("tokens"))
    raised = F.pow("tokens", F.lit(float(power)))
    return of.select(dim, (raised / F.lit(of.agg(F.sum(raised)).first()[0] or 1.0)).alias("share"))


@dataclass
class Mix:
    """``cells`` with ``probability``, the number of ``rounds`` of raking, and whether that was enough for it to converge."""

    cells: DataFrame
    shares: dict[str, DataFrame]
    aims: dict[str, DataFrame]
    total: float
    rounds: int
    converged: bool

    def report(self) -> DataFrame:
        """``dim``, ``value``, ``tokens``, and the shares that were ``wanted``, are ``feasible`` for the value by itself, and are ``expected``."""
        expected = self.cells.agg(F.sum(F.col("tokens") * F.col("probability"))).first()[0] or 1.0
        zero = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(c)
        parts = []
        for d, share in self.shares.items():
            got = self.cells.groupBy(d).agg(F.sum("tokens").alias("tokens"), (F.sum(F.col("tokens") * F.col("probability")) / F.lit(expected)).alias("expected"))
            aim = self.aims[d].select(F.col(d).alias("__aim"), (F.col("aim") / F.lit(self.total or 1.0)).alias("feasible"))
            mine = share.select(F.col(d).alias("value"), F.col("share").alias("wanted"), F.lit(True).alias("__wanted")).join(aim, F.col("value").eqNullSafe(F.col("__aim")), "left")
            mine = got.withColumn("__there", F.lit(True)).join(mine, F.col(d).eqNullSafe(F.col("value")), "full_outer")
            value = F.when(F.col("__there"), F.col(d)).otherwise(F.col("value")).cast("string")
            parts.append(mine.select(F.lit(d).alias("dim"), value.alias("value"), F.coalesce("tokens", F.lit(0)).alias("tokens"), zero("wanted"), zero("feasible"), zero("expected")))
        return reduce(DataFrame.unionByName, parts)

    def figures(self) -> dict[str, float]:
        """``kept``: the expected share of the wanted tokens; ``residual``: the largest gap between an expected share and the one that was wanted;
        ``off``: the largest gap to a feasible one, above 0 where values that are feasible one by one contradict each other."""
        room, expected = self.cells.agg(F.sum(F.when(F.col("wanted"), F.col("tokens"))), F.sum(F.col("tokens") * F.col("probability"))).first()
        residual, off = self.report().agg(F.max(F.abs(F.col("expected") - F.col("wanted"))), F.max(F.abs(F.col("expected") - F.col("feasible")))).first()
        return {"kept": (expected or 0.0) / (room or 1.0), "residual": residual or 0.0, "off": off or 0.0}


def _feasible(values: DataFrame, total: float) -> DataFrame:
    """``values`` (``there``, ``share``) with ``aim``: ``total`` tokens dealt by share, none more than are there.

    What a value lacks goes to the others by their shares, again and again while that exhausts more of them.
    """
    full, rate = F.lit(False), 0.0
    while True:
        taken, rest = values.agg(F.sum(F.when(full, F.col("there")).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("share")))).first()
        more = max(0.0, total - (taken or 0.0)) / rest if rest else rate
        if more <= rate:
            break
        rate = more
        full = F.col("share") * F.lit(rate) >= F.col("there")
    return values.withColumn("aim", F.least(F.col("there"), F.col("share") * F.lit(rate)))


def _pass(dims: Sequence[str], others: str, source: str) -> str:
    """One scaling of all dims in SQL.

    For each value, ``full`` are the tokens of its cells at probability 1 and ``rest`` the expected ones of its others. The
    factor of their weights is a step of Newton's method where the aim is above ``full``, and a proportional one, which
    can't go too far, elsewhere: either way repeated passes end where the value has its aim.
    """
    for d in dims:
        sums = f"SELECT *, sum(IF(weight >= 1, room, 0D)) OVER v AS full, sum(IF(weight < 1, room * weight, 0D)) OVER v AS rest FROM ({source}) WINDOW v AS (PARTITION BY `{d}`)"
        up, down = f"IF(rest > 0, (`aim_{d}` - full) / rest, 1D)", f"IF(full + rest > 0, `aim_{d}` / (full + rest), 1D)"
        factor = f"CASE WHEN `aim_{d}` > full THEN {up} WHEN rest > 0 OR `aim_{d}` < full THEN {down} ELSE 1D END"
        source = f"SELECT {others}, IF(weight > 0, weight * greatest(least({factor}, 1e3D), 1e-3D), 0D) AS weight FROM ({sums})"
    return source


def rake(cells: DataFrame, dims: Sequence[str], keep: float = KEEP, targets: dict[str, DataFrame] | None = None, powers: dict[str, float] = POWERS, hold: str = "tokens", rounds: int = MOST_ROUNDS) -> Mix:
    """Probabilities for ``cells`` (one row for each combination of ``dims`` with its ``tokens``) that meet all targets.

    Each pass scales the weights of the cells of one value after the other so that the value has its target; a
    probability is the weight, or 1 if that is less. So cells that are scarce are taken whole and the others make up for
    it. ``targets`` may name a table (the dim and ``share``, made to sum to 1) for a dim; values that it lacks get nothing.
    Otherwise ``default_target`` is taken.

    No token is taken twice, so a value that has fewer tokens than its target asks for can't have both its share and the
    whole count. ``hold`` is the choice: "tokens" keeps ``keep`` of the wanted tokens, takes such values whole and deals
    what they lack to the others by their shares; "shares" keeps fewer tokens, as many as leave each value its share.
    Either way the result tells what is kept and how far shares are off.
    """
    out, wanted, shares = cells, F.lit(True), {}
    for d in dims:
        if targets and d in targets:
            given = targets[d].groupBy(F.col(d)).agg(F.sum("share").cast("double").alias("share")).where("share > 0")
            share = given.select(d, (F.col("share") / F.lit(given.agg(F.sum("share")).first()[0] or 1.0)).alias("share"))
            wanted &= F.col(f"__{d}").isNotNull()
        else:
            share = default_target(cells, d, powers[d])
        shares[d] = share
        out = out.join(share.select(F.col(d).alias("__value"), F.col("share").alias(f"__{d}")), F.col(d).eqNullSafe(F.col("__value")), "left").drop("__value")
    out = materialise(out.withColumn("wanted", wanted).withColumn("room", F.when(F.col("wanted"), F.col("tokens")).otherwise(0).cast("double")), "shares")
    room, n = out.agg(F.sum("room"), F.count("*")).first()
    room = room or 0.0
    total, values = keep * room, {}
    for d in dims:
        there = out.groupBy(d).agg(F.sum("room").alias("there"), F.max(f"__{d}").alias("share")).where("there > 0 AND share > 0")
        values[d] = materialise(there, "values")
        if hold == "shares":
            lacking = 1.0 - (values[d].agg(F.sum("share")).first()[0] or 0.0)  # of values without tokens: nothing meets them
            total = min(total, (values[d].agg(F.min(F.col("there") / F.col("share"))).first()[0] or 0.0) * (1.0 - max(lacking, 0.0)))
    aims = {d: materialise(_feasible(values[d], total), "aims") for d in dims}
    for d in dims:
        out = out.join(aims[d].select(F.col(d).alias("__value"), F.col("aim").alias("__aim")), F.col(d).eqNullSafe(F.col("__value")), "left").withColumn(f"aim_{d}", F.coalesce("__aim", F.lit(0.0))).drop("__value", "__aim")
    start = total / room if room else 0.0
    now = materialise(out.withColumn("weight", F.when(F.col("room") > 0, F.lit(start)).otherwise(0.0)), "raked")
    done, converged = 0, room == 0.0
    while not converged and done < rounds:
        others, after = ", ".join(f"`{c}`" for c in now.columns if c != "weight"), now.coalesce(1) if n <= SMALL else now
        for _ in range(ROUNDS - 1):
            after = now.sparkSession.sql(_pass(dims, others, "SELECT * FROM {cells}"), cells=after)
        after = now.sparkSession.sql(_pass(dims, others + ", was", "SELECT *, least(1D, weight) AS was FROM {cells}"), cells=after)
        after = materialise(after, "raked")
        discard(now)
        change = after.agg(F.max(F.abs(F.least(F.lit(1.0), F.col("weight")) - F.col("was")))).first()[0]
        now, done, converged = after.drop("was"), done + ROUNDS, change is None or change <= TOLERANCE
    chance = F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.col("weight"))).when(F.col("wanted"), 1.0).otherwise(0.0)
    fitted = materialise(now.withColumn("probability", chance).select(*cells.columns, "wanted", "probability"), "chance")
    discard(now)
    return Mix(fitted, shares, aims, total, done, converged)


def draw(doc_id: Column) -> Column:
    """A number from 0 up to 1 that depends on the id alone."""
    return F.conv(F.substring(F.md5(doc_id.cast("string").cast("binary")), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def with_cells(docs: DataFrame) -> DataFrame:
    """``docs`` with ``tokens`` and, unless it has one, ``topic``."""
    out = docs.select([c for c in docs.columns if c not in ("tokens", "probability", "sampled")]).withColumn("tokens", F.coalesce(n_words(F.col("text")), F.lit(0)))
    return out if "topic" in out.columns else out.withColumn("topic", topic_by_form(F.col("tokens")))


def plan_mix(docs: DataFrame, keep: float = KEEP, targets: dict[str, DataFrame] | None = None, hold: str = "tokens", rounds: int = MOST_ROUNDS) -> Mix:
    """The probabilities of all combinations of source, language and topic of ``docs``, and how far they meet the targets.

    Tokens are summed by combination before anything is shuffled, so raking sees their number, not that of the rows.
    """
    cells = materialise(with_cells(docs).groupBy(*DIMS).agg(F.sum("tokens").alias("tokens")), "cells")
    return rake(cells, DIMS, keep, targets, hold=hold, rounds=rounds)


def mix_sources(docs: DataFrame, keep: float = KEEP, targets: dict[str, DataFrame] | None = None, hold: str = "tokens", mix: Mix | None = None) -> DataFrame:
    """``docs`` with ``tokens``, ``topic``, ``probability`` and ``sampled``.

    A document is sampled if its id's draw is under the probability of its source, language and topic; ``rake`` tells what
    targets mean and what ``hold`` gives up where they ask for more than there is, ``mix`` is a plan made before (of
    ``plan_mix``, which returns the figures too). A column ``topic`` of ``docs`` is used if there is one; the stand-in is a
    class of length.

    A null source, language or topic is a value of its own. Values that a given target doesn't have are not sampled. Texts
    that are null or blank have no tokens; their cells have probability 1 (0 if not wanted) where no other text is in them.
    A null id draws 0, so its row is sampled at any probability above 0. Rows that share an id share a draw. Columns named
    like the results are replaced. An empty table gives an empty result.
    """
    out = with_cells(docs)
    plan = mix or plan_mix(docs, keep, targets, hold)
    chance = plan.cells.select(*(F.col(d).alias(f"__{d}") for d in DIMS), "probability")
    same = [F.col(d).eqNullSafe(F.col(f"__{d}")) for d in DIMS]
    # A few bytes for each combination of source, language and topic: broadcast up to the session's threshold, shuffled beyond.
    out = out.join(chance, same, "left").drop(*(f"__{d}" for d in DIMS)).withColumn("probability", F.coalesce("probability", F.lit(0.0)))
    return out.withColumn("sampled", F.coalesce(draw(F.col("doc_id")), F.lit(0.0)) < F.col("probability"))
