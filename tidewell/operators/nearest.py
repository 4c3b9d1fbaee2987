"""The greatest similarity of a row with any other: a weighted sum of two Jaccard similarities and of equal tags."""

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..tables import materialise

#: So many of the most common terms of each of the two sets are bits of a mask.
COMMON = 512
#: Rows in a block, and blocks at least, so that small tables are dealt to several tasks, too.
BLOCK, BLOCKS = 1 << 16, 4
#: Meetings that a task holds at once.
STEP = 1 << 17

#: What a score is the sum of, in this order: the name of a part ("a", "b" or "tag") and its weight.
Parts = Sequence[tuple[str, float]]


def greatest_alike(mine: DataFrame, theirs: DataFrame, parts: Parts, floor: Callable[[DataFrame], DataFrame], unasked: Sequence[str] = (), common: int = COMMON) -> DataFrame:
    """``form``, ``who`` and ``greatest``: the most that a row of ``mine`` has in common with one of ``theirs`` of another ``who``.

    Both hold ``form`` (equal for equal sets and tags), ``who`` (not null), ``a`` and ``b`` (sets of strings) and ``tag``
    (null is like nothing), and should be stored, for they are read several times. ``floor`` gives asked rows (with
    ``unit``) a ``floor`` that they reach in any case, at least what a pair reaches that has only the tag, or only terms of
    ``b`` from ``unasked``, in common.

    A form that two have is as like itself as can be. All others are compared in pairs of blocks: no pair of rows leaves
    its task, so what is shuffled and held doesn't grow with the pairs. A term is a number there, and those that no other
    form has are left out.
    """
    held = materialise(_forms(theirs, "form").withColumn("unit", F.monotonically_increasing_id() * 2), "alike-forms")
    single = F.col("low") == F.col("high")
    whole = sum((F.when(F.size(n) > 0 if n != "tag" else F.col("tag").isNotNull(), w).otherwise(0.0) for n, w in parts), F.lit(0.0))
    if mine is theirs:
        asks, several = held.where(single), held.where(~single).select("form", whole.alias("greatest"))
    else:
        known = held.where(~single).select("form", F.lit(True).alias("several"))
        own = materialise(_forms(mine, "form", "who").withColumn("unit", F.monotonically_increasing_id() * 2 + 1).join(known.hint("merge"), "form", "left"), "alike-asks")
        asks, several = own.where("several IS NULL").drop("several"), own.where("several").select("form", whole.alias("greatest")).distinct()
    asks = asks.join(floor(asks.withColumnRenamed("low", "who")).hint("merge"), "unit", "left").withColumn("floor", F.coalesce("floor", F.lit(0.0)))
    rows = asks.withColumns({"asks": F.lit(True), "answers": F.lit(mine is theirs)})
    others = held if mine is not theirs else held.where(~single)
    rows = rows.unionByName(others.withColumns({"floor": F.lit(None).cast("double"), "asks": F.lit(False), "answers": F.lit(True)}))
    terms = _numbers(held, unasked, 2 if mine is theirs else 1, common)
    sized = rows.select("unit", "form", "low", "high", "tag", "floor", "asks", "answers", F.size("a").alias("n_a"), F.size("b").alias("n_b"), _terms().alias("terms"))
    rows = materialise(sized, "alike-rows")
    numbered = rows.select("unit", F.explode("terms").alias("term")).join(terms.hint("merge"), "term").groupBy("unit").agg(F.collect_list("number").alias("numbers"))
    found = _in_blocks(rows.drop("terms", "form").join(numbered.hint("merge"), "unit"), rows.count(), parts, len(unasked), common)
    best = found.groupBy("unit").agg(F.max("greatest").alias("found"))
    asked = rows.where("asks").select("unit", "form", F.col("low").alias("who"), "floor").join(best.hint("merge"), "unit", "left")
    out = asked.select("form", "who", F.greatest("floor", "found").alias("greatest"))
    each = mine.select("form", "who").distinct().join(several.hint("merge"), "form").select("form", "who", "greatest")
    return out.unionByName(each)


def _forms(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(*(F.first(c).alias(c) for c in ("a", "b", "tag")), *((F.min("who").alias("low"), F.max("who").alias("high")) if "who" not in keys else ())).select(
        "form", "a", "b", "tag", *(("low", "high") if "who" not in keys else (F.col("who").alias("low"), F.col("who").alias("high")))
    )


def _terms() -> Column:
    """All terms of a row; their first letter says which set they are of."""
    return F.concat(F.transform("a", lambda t: F.concat(F.lit("a"), t)), F.transform("b", lambda t: F.concat(F.lit("b"), t)))


def _numbers(held: DataFrame, unasked: Sequence[str], least: int, common: int) -> DataFrame:
    """``term`` and ``number`` of the terms that ``least`` forms have; odd ones are of ``b``.

    Numbers under ``2 * common`` are those of the most common terms, after the ``unasked`` ones, which always are among them.
    """
    counted = held.select(F.explode(_terms()).alias("term")).groupBy("term").agg(F.count("*").alias("held")).where(F.col("held") >= least)
    place = F.array_position(F.array(*(F.lit("b" + t) for t in unasked)), F.col("term")) if unasked else F.lit(0)
    counted = materialise(counted.withColumns({"of_b": F.col("term").startswith("b").cast("long"), "place": place}).withColumn("at", F.monotonically_increasing_id()), "alike-terms")
    top = None
    for of_b, first in ((0, 0), (1, len(unasked))):
        most = counted.where((F.col("of_b") == of_b) & (F.col("place") == 0)).orderBy(F.desc("held"), "term").limit(common - first)
        ranked = most.agg(F.array_sort(F.collect_list(F.struct((-F.col("held")).alias("held"), "term"))).alias("most")).select(F.posexplode("most").alias("rank", "x")).select("x.term", ((F.col("rank") + first) * 2 + of_b).cast("long").alias("common"))
        top = ranked if top is None else top.unionByName(ranked)
    rare = 2 * common + F.col("at") * 2 + F.col("of_b")
    number = F.when(F.col("place") > 0, (F.col("place") - 1) * 2 + 1).otherwise(F.coalesce("common", rare))
    return materialise(counted.join(F.broadcast(top), "term", "left").select("term", number.alias("number")), "alike-numbers")


def _in_blocks(rows: DataFrame, n: int, parts: Parts, unasked: int, common: int) -> DataFrame:
    """Every block of asked rows against every block of others: ``unit`` and ``greatest`` for each pair of blocks."""
    blocks = max(BLOCKS, -(-n // BLOCK))
    every, own = F.sequence(F.lit(0), F.lit(blocks - 1)), F.pmod(F.xxhash64("unit"), F.lit(blocks)).cast("int")
    none = F.array().cast("array<struct<mine:int,theirs:int,asking:boolean>>")
    at = lambda mine, theirs, asking: F.struct(mine.alias("mine"), theirs.alias("theirs"), F.lit(asking).alias("asking"))
    meets = F.concat(F.when(F.col("asks"), F.transform(every, lambda j: at(F.col("own"), j, True))).otherwise(none), F.when(F.col("answers"), F.transform(every, lambda j: at(j, F.col("own"), False))).otherwise(none))
    dealt = rows.withColumn("own", own).select("unit", "low", "high", "tag", "floor", "n_a", "n_b", "numbers", F.inline(meets))
    # A number of its own: little is read in a pair of blocks for what is done there, so these must not be put together.
    dealt = dealt.repartition(4 * blocks * blocks, "mine", "theirs")

    def compare(table: pa.Table) -> pa.Table:
        asking, low, high, tag = table["asking"], *_coded(table["low"], table["high"]), _coded(table["tag"])[0]
        keep = [np.flatnonzero(asking.to_numpy() == side) for side in (True, False)]
        x, y = (_Rows(table.take(pa.array(i)), low[i], high[i], tag[i], common) for i in keep)
        return pa.table({"unit": pa.array(x.unit, pa.int64()), "greatest": pa.array(_greatest(x, y, parts, unasked, common), pa.float64())})

    return dealt.groupBy("mine", "theirs").applyInArrow(compare, "unit long, greatest double")


def _coded(*columns: pa.ChunkedArray) -> list[np.ndarray]:
    """Strings as numbers, equal in all columns; -1 for a null."""
    chunks = [c for column in columns for c in column.chunks]
    codes = pa.chunked_array(chunks, columns[0].type).combine_chunks().dictionary_encode()
    codes = codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes
    return np.split(codes.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64), len(columns)) if chunks else [np.empty(0, np.int64)] * len(columns)


class _Rows:
    """Rows of a block as arrays: sizes and masks of both sets, terms one after another with the row that each is of."""

    def __init__(self, table: pa.Table, low: np.ndarray, high: np.ndarray, tag: np.ndarray, common: int):
        self.unit, self.floor = table["unit"].to_numpy(), table["floor"].to_numpy()
        self.low, self.high, self.tag = low, high, tag
        self.size = [table[n].to_numpy().astype(np.int64) for n in ("n_a", "n_b")]
        self.terms = pc.list_flatten(table["numbers"]).to_numpy().astype(np.int64)
        self.of = np.repeat(np.arange(len(low)), pc.list_value_length(table["numbers"]).to_numpy())
        t, of = (c[self.terms < 2 * common] for c in (self.terms, self.of))
        self.masks = np.zeros((2, len(low), -(-common // 64)), np.uint64)
        np.bitwise_or.at(self.masks, (t & 1, of, t >> 7), np.uint64(1) << ((t >> 1) & 63).astype(np.uint64))
        self.bits = np.bitwise_count(self.masks).sum(2, dtype=np.int64)


def _ranges(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges, and which range each is of."""
    of = np.repeat(np.arange(len(counts)), counts)
    return np.arange(len(of)) + np.repeat(starts - np.cumsum(counts) + counts, counts), of


def _steps(counts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of the rows, so that the counts of each part come to about ``STEP``."""
    total = np.cumsum(counts)
    ends = [0, *np.unique(np.minimum(np.searchsorted(total, np.arange(STEP, (total[-1] if len(total) else 0) + STEP, STEP)) + 1, len(counts)))]
    return zip(ends, ends[1:], strict=False)


def _starts(sorted_values: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before."""
    return np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1])) if len(sorted_values) else np.empty(0, np.int64)


def _greatest(x: _Rows, y: _Rows, parts: Parts, unasked: int, common: int) -> np.ndarray:
    """For each row of ``x`` the greatest of its floor and its similarities with rows of ``y``.

    Pairs with a rare term in common are met under it: rare terms in common are counted, common ones are bits of both
    masks. What is left are pairs with common terms only, which ``_by_common_terms`` looks for above what is known by then.
    """
    best = x.floor.copy()

    def scores(px: np.ndarray, py: np.ndarray, both: Sequence[np.ndarray]) -> np.ndarray:
        total = np.zeros(len(px))
        for name, w in parts:
            if name == "tag":
                total = total + w * ((x.tag[px] == y.tag[py]) & (x.tag[px] >= 0))
            else:
                k = int(name == "b")
                total = total + both[k] / np.maximum(x.size[k][px] + y.size[k][py] - both[k], 1) * w
        return total

    def raise_to(px: np.ndarray, score: np.ndarray) -> None:
        """``px`` is in order."""
        at = _starts(px)
        if len(at):
            best[px[at]] = np.maximum(best[px[at]], np.maximum.reduceat(score, at))

    masked = lambda k, px, py: np.bitwise_count(x.masks[k][px] & y.masks[k][py]).sum(1, dtype=np.int64)
    own = lambda px, py: (y.low[py] == y.high[py]) & (y.low[py] == x.low[px])

    rare, held = x.terms >= 2 * common, y.terms >= 2 * common
    terms, of = x.terms[rare], x.of[rare]
    order = np.argsort(y.terms[held], kind="stable")
    known, post = y.terms[held][order], y.of[held][order]
    start = np.searchsorted(known, terms)
    count = np.searchsorted(known, terms, "right") - start
    first = np.searchsorted(of, np.arange(len(best) + 1))
    for p, q in _steps(np.bincount(of, count, minlength=len(best)).astype(np.int64)):
        some = slice(first[p], first[q])
        place, i = _ranges(start[some], count[some])
        met = ((of[some][i] - p) * len(y.low) + post[place]) * 2 + (terms[some][i] & 1)
        met.sort()
        at = _starts(met >> 1)
        if not len(at):
            continue
        pair, all_of = met[at] >> 1, np.diff(np.append(at, len(met)))
        of_b = np.add.reduceat(met & 1, at)
        px, py = pair // len(y.low) + p, pair % len(y.low)
        left = ~own(px, py)
        px, py, both = px[left], py[left], [(all_of - of_b)[left], of_b[left]]
        raise_to(px, scores(px, py, both))
        left = scores(px, py, [both[k] + np.minimum(x.bits[k][px], y.bits[k][py]) for k in (0, 1)]) > best[px]
        px, py, both = px[left], py[left], [c[left] for c in both]
        raise_to(px, scores(px, py, [both[k] + masked(k, px, py) for k in (0, 1)]))

    del known, post, order, terms, of, start, count
    for px, py in _by_common_terms(x, y, dict(parts), best, unasked, common):
        left = ~own(px, py)
        px, py = px[left], py[left]
        raise_to(px, scores(px, py, [masked(k, px, py) for k in (0, 1)]))
    return best


def _by_common_terms(x: _Rows, y: _Rows, weights: dict[str, float], best: np.ndarray, unasked: int, common: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (rows of ``x`` in order) with a common term in common, among them all that have no other and are above ``best``.

    A pair is met on its first term in common, the rarest first. Where r of n terms are left, a set of m has at most r of
    them: it has need = r / (n + m - r) at most, so m is at most r * (1 + 1 / need) - n, and at least need * n. What need
    is depends on whether tags are equal, so terms are looked for among equal tags, too. The ``unasked`` are in what is
    left, but nothing is met on them.
    """
    weight = np.array([weights["a"], weights["b"]])
    n, m = np.stack(x.size), np.stack(y.size)
    most = int(m.max(initial=0)) + 1

    def asked(rows: _Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        terms, of = (c[rows.terms < 2 * common] for c in (rows.terms, rows.of))
        fixed = (terms & 1 == 1) & (terms >> 1 < unasked)
        return terms[~fixed], of[~fixed], np.bincount(of[fixed], minlength=len(rows.low))

    t, of, _ = asked(y)
    size = m[t & 1, of]
    tags = int(max(x.tag.max(initial=-1), y.tag.max(initial=-1))) + 2  # with 0 for any tag
    tagged = y.tag[of] >= 0
    key = np.concatenate([t * tags, (t * tags + y.tag[of] + 1)[tagged]]) * (most + 1) + np.concatenate([size, size[tagged]])
    order = np.argsort(key, kind="stable")
    key, post = key[order], np.concatenate([of, of[tagged]])[order]

    t, of, fixed = asked(x)
    order = np.lexsort((-(t >> 1), of))
    t, of = t[order], of[order]
    f, end = t & 1, np.searchsorted(of, np.arange(len(best)), "right")
    after = [np.append(0, np.cumsum(f == k)) for k in (0, 1)]
    left = np.stack([after[k][end[of]] - after[k][:-1] + (fixed[of] if k else 0) for k in (0, 1)])
    i, found = np.arange(len(t)), []
    for equal_tags in (0, 1):
        other = np.minimum(1, left[1 - f, i] / np.maximum(n[1 - f, of], 1)) * weight[1 - f]
        need = np.maximum((best[of] - other - equal_tags * weights["tag"]) / weight[f], 1e-9)
        low, high = np.maximum(1, np.ceil(n[f, of] * need - 1e-6)), np.minimum(most, np.floor(left[f, i] * (1 + 1 / need) - n[f, of] + 1e-6))
        may = np.flatnonzero((low <= high) & ((x.tag[of] >= 0) | (equal_tags == 0)))
        name = (t * tags + equal_tags * (x.tag[of] + 1))[may] * (most + 1)
        start = np.searchsorted(key, name + low[may].astype(np.int64))
        found.append((of[may], start, np.maximum(np.searchsorted(key, name + high[may].astype(np.int64), "right") - start, 0)))
    of, start, count = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.argsort(of, kind="stable")
    of, start, count = of[order], start[order], count[order]
    for p, q in _steps(count):
        place, i = _ranges(start[p:q], count[p:q])
        yield of[p:q][i], post[place]
