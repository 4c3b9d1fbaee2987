"""Spelling variants by dense prefix-suffix tiling: blocks of code-point matrices are compared for words that one edit parts."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..tables import discard, materialise
from .words import frugal

# What a word is made of, and which letters have a lower case here.
LETTERS, UPPER, LOWER = "[A-Za-zÀ-ÿ]", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Code points of a word and its occurrences, at least.
LENGTH, TIMES = 7, 2
#: One run in so many loses a code point.
LOSSES = 31
#: How many times as frequent as a word its form must be.
FORM = 10
#: Words of a tile above which it is dealt anew by narrower zones.
TILE = 512
#: Rows of a block, and cells of a block's matrix at most.
BLOCK, CELLS = 256, 1 << 20


def word_counts(docs: DataFrame, least: int = LENGTH, times: int = TIMES) -> DataFrame:
    """``word`` and ``n``, its occurrences in all texts, for words of ``least`` code points and ``times`` occurrences or more.

    Words are maximal runs of ``LETTERS`` with A to Z in lower case. Where ``LOSSES`` divides the CRC-32 of
    ``<doc_id>:<run>``, the run's code point at that number modulo its length is left out; a null id is empty there.
    """
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{least},}}"), F.lit(0))).alias("run"))
    runs = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    word = F.when(h % LOSSES == 0, F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))).otherwise(F.col("run"))
    return runs.select(word.alias("word")).where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= times)


def _keyed(rows: DataFrame) -> DataFrame:
    """``key``: a hash of what two words with one edit in the zone ``low`` to ``high`` of ``longer`` places have in common."""
    before, after = F.substring(F.col("word"), F.lit(1), F.col("low")), F.col("longer") - F.col("high")
    behind = F.when(after > 0, F.substring(F.col("word"), F.length("word") - after + 1, after)).otherwise("")
    return rows.withColumn("key", F.xxhash64("longer", "low", "high", before, behind))


def _zones(rows: DataFrame) -> DataFrame:
    """Each zone in two halves."""
    middle = F.expr("(low + high) DIV 2").cast("int")
    halves = F.array(F.struct(F.col("low").alias("low"), middle.alias("high")), F.struct(middle.alias("low"), F.col("high").alias("high")))
    return rows.select("word", "n", "longer", F.inline(halves))


def tiles(words: DataFrame, most: int = TILE) -> DataFrame:
    """``word``, ``n`` -> rows with ``key``, ``longer``, ``low``, ``high``: the tiles in which a word may meet near ones.

    The longer of two near words has ``longer`` places. One edit lies in one half of them, and the words agree on the
    other half: they meet there. Tiles of more than ``most`` rows are dealt anew by the halves of their zone, again and
    again; in a zone of one place no more words can agree on all the rest than the alphabet has letters (and one that
    lacks the place), so that no tile stays large, however many words begin alike.
    """
    spans = F.array(F.length("word"), F.length("word") + 1)
    rows = _keyed(_zones(words.select("word", "n", F.explode(spans).alias("longer")).select("*", F.lit(0).alias("low"), F.col("longer").alias("high"))))
    done, tile = [], ["key", "longer", "low", "high"]
    while True:
        big = materialise(rows.groupBy(*tile).agg(F.count("*").alias("rows")).where(f"rows > {int(most)} AND high - low > 1").drop("rows"), "large-tiles")
        if big.isEmpty():
            discard(big)
            done.append(rows)
            break
        done.append(rows.join(big, tile, "left_anti"))
        rows = materialise(_keyed(_zones(rows.join(big, tile, "left_semi"))), "narrower")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


_NEAR = "word string, n_near long, best_n long, best string"
_arrow = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _points(words: list[str], lengths: np.ndarray, width: int, right: bool) -> np.ndarray:
    """Code points in a matrix, at its left or right end, and zeros elsewhere."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
    out = np.zeros((len(words), width), dtype=np.uint8 if points.max() < 256 else np.uint32)
    places = np.arange(width)
    inside = places >= (width - lengths)[:, None] if right else places < lengths[:, None]
    out[inside] = points
    return out


def _same(a: np.ndarray, b: np.ndarray, order: range) -> np.ndarray:
    """For each row of ``a`` and of ``b``: in how many columns they agree, in ``order``, until they first differ."""
    alive, total = np.ones((len(a), len(b)), dtype=bool), np.zeros((len(a), len(b)), dtype=np.int16 if len(order) < 1 << 15 else np.int32)
    for j in order:
        alive &= a[:, j, None] == b[None, :, j]
        if not alive.any():
            break
        total += alive
    return total


class _Block:
    """Rows of one or more tiles, with their matrices."""

    def __init__(self, rows: dict[str, list]):
        self.words, self.n = list(rows["word"]), np.array(rows["n"], dtype=np.int64)
        self.tile = [np.array(rows[c], dtype=np.int64) for c in ("key", "longer", "low", "high")]
        self.length = np.array([len(w) for w in self.words], dtype=np.int64)
        self.width = int(self.length.max())
        self._rank: np.ndarray | None = None

    def rank(self) -> np.ndarray:
        """Places of the rows by count, largest first, then by word."""
        if self._rank is None:
            self._rank = np.empty(len(self.words), dtype=np.int64)
            self._rank[sorted(range(len(self.words)), key=lambda i: (-self.n[i], self.words[i]))] = np.arange(len(self.words))
        return self._rank

    def near(self, other: "_Block") -> tuple[np.ndarray, np.ndarray]:
        """Places of the pairs that one edit parts, in the zone of a tile that both stand in."""
        meet = np.ones((len(self.words), len(other.words)), dtype=bool)
        for mine, its in zip(self.tile, other.tile, strict=True):
            meet &= mine[:, None] == its
        _, longer, low, high = (x[:, None] for x in self.tile)
        meet &= np.maximum(self.length[:, None], other.length) == longer
        if self is other:
            meet = np.triu(meet, 1)
        if not meet.any():
            return np.empty(0, np.int64), np.empty(0, np.int64)
        width, both = max(self.width, other.width), np.minimum(self.length[:, None], other.length)
        left, right = (np.minimum(_same(_points(self.words, self.length, width, at_end), _points(other.words, other.length, width, at_end), order), both) for at_end, order in ((False, range(width)), (True, range(width - 1, -1, -1))))
        meet &= (left >= low) & (left < high) & (left + right >= longer - 1)
        return np.nonzero(meet)


def _findings(a: _Block, b: _Block) -> Iterator[tuple[str, int, int, str]]:
    """What the pairs of two blocks add to each of their words: how many near ones, and the best of them."""
    i, j = a.near(b)
    if not len(i):
        return
    for x, y, own, its in ((a, b, i, j), (b, a, j, i)):
        order = np.lexsort((y.rank()[its], own))
        rows, first, count = np.unique(own[order], return_index=True, return_counts=True)
        for p, q, c in zip(rows.tolist(), its[order][first].tolist(), count.tolist(), strict=True):
            yield x.words[p], c, int(y.n[q]), y.words[q]


@frugal
def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by tile -> findings. Kept: the blocks of the tile that is being read; ends of tiles may share a block."""
    names = ("word", "n", "key", "longer", "low", "high")
    rows: dict[str, list] = {c: [] for c in names}
    earlier: list[_Block] = []
    found: list[tuple[str, int, int, str]] = []

    def flush() -> None:
        """Compare the rows that were gathered with themselves and with earlier blocks of their first tile."""
        nonlocal earlier
        block = _Block(rows)
        for other in [*earlier, block]:
            found.extend(_findings(other, block))
        earlier = [b for b in [*earlier, block] if b.tile[0][-1] == block.tile[0][-1]]
        for values in rows.values():
            values.clear()

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in names]
        for row in zip(*columns, strict=True):
            for c, v in zip(names, row, strict=True):
                rows[c].append(v)
            n = len(rows["word"])
            if n >= BLOCK or n * row[3] >= CELLS:
                flush()
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*found, strict=True), _arrow, strict=True)], schema=_arrow)
            found.clear()
    if rows["word"]:
        flush()
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*found, strict=True), _arrow, strict=True)], schema=_arrow)


def near_words(words: DataFrame, most: int = TILE) -> DataFrame:
    """``word``, ``n_near``, ``best_n``, ``best``: how many words one edit parts from a word, and the most frequent of them.

    The edit of a pair is where the two first differ: it lies in one zone only, so each pair counts once.
    """
    dealt = tiles(words, most).select("word", "n", "key", "longer", "low", "high").repartition("key").sortWithinPartitions("longer", "key", "low", "high")
    found = dealt.mapInArrow(_compare, _NEAR)
    first = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("first")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first).select("word", "n_near", (-F.col("first.n")).alias("best_n"), F.col("first.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``form`` -> ``word``, ``root``: forms followed to the last, which has none.

    Each round doubles the steps that are taken. A form is ``FORM`` times as frequent as its word, so paths have no
    circles and at most as many steps as the largest count has digits.
    """
    now = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        after = now.select(F.col("word").alias("root"), F.col("root").alias("later"))
        after = materialise(now.join(after, "root", "left").select("word", F.coalesce("later", "root").alias("root"), F.col("later").isNotNull().alias("went")), "roots")
        discard(now)
        now = after.drop("went")
        if after.where("went").isEmpty():
            return now


def spelling_variants(docs: DataFrame, most: int = TILE, ratio: int = FORM) -> DataFrame:
    """``doc_id``, ``text`` -> ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``: one row for each word.

    ``form`` is the most frequent near word (of equal ones the first in code-point order) if it occurs ``ratio`` times as
    often as the word, else null; ``root`` follows forms to the last and is the word itself if it has none; ``n_near`` is
    the number of words that one inserted, deleted or replaced code point parts from it. Null texts have no words, other
    columns don't matter, repeated rows count each time, and an empty table has no rows.
    """
    words = materialise(word_counts(docs), "words")
    near = words.join(near_words(words, most), "word", "left").withColumn("is_form", F.coalesce(F.col("best_n") >= ratio * F.col("n"), F.lit(False)))
    out = near.select("word", F.when(F.col("is_form"), F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("is_form"), F.col("best_n")).alias("form_n"))
    out = materialise(out, "spellings")
    found = out.join(roots(out.where("form IS NOT NULL")), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
