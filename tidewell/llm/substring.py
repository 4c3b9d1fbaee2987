"""Substring dedup: passages that repeat across documents, found by compact windows and verified on whole texts.

A text is the sequence of its five-word shingles. Under each hash function the Cartesian tree over the shingles' hashes
gives compact windows: all runs inside a node's window that hold its place share that smallest hash. Windows of all hash
functions are joined by their intervals, so that runs with the same smallest hashes become one row with their signature.
Documents with a signature in common meet, and both whole texts decide which passages they share.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..tables import discard, materialise
from .words import SHINGLE, frugal, mix, shingles, words

#: Words of the shortest passage.
LEAST_WORDS = 50
THRESHOLD = 0.8
#: Hash functions whose windows are joined.
TURNS = 3
#: Grams of the texts that are looked at together, and the bits that number them; they change nothing but memory.
BATCH, BATCH_BITS = 1 << 18, 20
_END = np.zeros(1, dtype=np.uint64)
#: Documents compared with one earlier document in a row.
FAN = 64
#: Documents that common signatures are looked for in, share of these that makes one common, and parts that its documents are dealt into.
SAMPLE, COMMON, PARTS = 2000, 0.02, 64


def seed_grams(least: int, threshold: float) -> int:
    """Every passage of ``least`` shingles or more with a partner at ``threshold`` has a word-for-word run of at least so many.

    Of a passage with c common shingles at most (1 / threshold - 1) c are not common, in both texts together, and a gap
    between two runs costs at least two shingles fewer than twice the words of a shingle. So there are few runs, and the
    longest has its share of c, which is at least threshold * least.
    """
    slack, low = 1 / threshold - 1 + 1e-9, max(1, math.ceil(threshold * least - 1e-9))
    return min(math.ceil(c / (int(slack * c / (2 * SHINGLE - 2)) + 1)) for c in range(low, 40 * low + 1))


def compact_windows(grams: np.ndarray, ends: np.ndarray, least: int, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, left and right end of every compact window that holds a run of ``least`` grams, in the order of the places.

    ``grams`` are those of several texts with one more after each text, at ``ends``, which no run may hold. Only a place
    that is smallest in some run of ``least`` grams has such a window, and so has the nearest smaller place on either side
    of it; the tree is therefore built on those places alone. Equal hashes count from the left.
    """
    n = len(grams)
    if n <= least:
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    low = np.uint64((1 << max(BATCH_BITS, n.bit_length())) - 1)
    x = grams * np.uint64(2 * turn + 0x9E3779B97F4A7C15)  # grams are mixed, so that one more multiplication is enough
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x[ends] = 0
    key = (x & ~low) | np.arange(n, dtype=np.uint64)
    run, width = key, 1
    while width < least:
        step = min(width, least - width)
        run, width = np.minimum(run[:-step], run[step:]), width + step
    places = (run[np.r_[True, run[1:] != run[:-1]]] & low).astype(np.int64)
    rank = np.empty(len(places), dtype=np.int64)
    rank[np.argsort(key[places])] = np.arange(len(places))
    left, right, nodes = [-1] * len(places), [len(places)] * len(places), []  # as numbers of places
    for i, k in enumerate(rank.tolist()):
        while nodes and nodes[-1][1] > k:
            right[nodes.pop()[0]] = i
        if nodes:
            left[i] = nodes[-1][0]
        nodes.append((i, k))
    edges = np.r_[places, n, -1]  # of no smaller place: the ends of all
    inside = key[places] > low
    return places[inside], edges[np.array(left)][inside] + 1, edges[np.array(right)][inside] - 1


def signatures(texts: list[np.ndarray], lengths: tuple[int, ...], turns: int = TURNS) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of all runs of the given ``lengths`` of each text's grams, and the number of the text; each once for a text.

    A signature is one hash of the grams that are smallest in the run under each of the ``turns``. The runs of a length
    that a compact window holds begin in one interval. The intervals of all hash functions are joined: every begin of one
    is the begin of a joined interval, in which each function has one window.
    """
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    grams = np.concatenate([x for t in texts for x in (t, _END)])
    windows = [compact_windows(grams, ends, min(lengths), turn) for turn in range(turns)]
    keys, owners = [], []
    for length in lengths:
        begins, at = [], []
        for place, left, right in windows:
            first = np.maximum(left, place - length + 1)
            held = first <= np.minimum(place, right - length + 1)
            begins.append(first[held])
            at.append(place[held])
        every = np.sort(np.concatenate(begins))
        every = every[np.diff(every, prepend=-1) > 0]
        key = np.full(len(every), length, dtype=np.uint64)
        for b, c in zip(begins, at, strict=True):
            key = mix(key + grams[c[np.searchsorted(b, every, "right") - 1]])
        keys.append(key)
        owners.append(np.searchsorted(ends, every))
    key, owner = np.concatenate(keys), np.concatenate(owners)
    order = np.lexsort((key, owner))
    key, owner = key[order], owner[order]
    once = np.r_[True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])] if len(key) else np.empty(0, bool)
    return key[once], owner[once]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).where("doc is not null and text is not null")


def common_signatures(texts: DataFrame, lengths: tuple[int, ...]) -> np.ndarray:
    """Signatures that more than a share ``COMMON`` of a bounded sample of documents has.

    They are dealt into parts; nothing else depends on them. There are at most as many as the sample's signatures
    divided by the documents that make one common.
    """
    chosen = texts.select("doc").distinct().orderBy(F.xxhash64("doc"), "doc").limit(SAMPLE)
    keys = _keys(texts.join(F.broadcast(chosen), "doc"), lengths, np.empty(0, np.uint64)).distinct()
    found = keys.groupBy("key").count().where(F.col("count") > COMMON * SAMPLE).select("key").toPandas()
    return np.sort(found["key"].to_numpy(np.int64).view(np.uint64))


KEYS = "key long, doc long, common long"


def _keys(texts: DataFrame, lengths: tuple[int, ...], common: np.ndarray) -> DataFrame:
    """``key`` and ``doc`` for each signature of each text. A common signature is in ``common``, and its key has the document's part."""

    def combine(docs: list[int], grams: list[np.ndarray]) -> pa.RecordBatch:
        key, owner = signatures(grams, lengths)
        doc, often = np.array(docs, dtype=np.int64)[owner], np.isin(key, common)
        part = mix(doc.view(np.uint64)) % np.uint64(PARTS) + np.uint64(1)
        dealt = np.where(often, mix(key + part), key)
        return pa.RecordBatch.from_arrays([pa.array(dealt.view(np.int64)), pa.array(doc), pa.array(key.view(np.int64), mask=~often)], [x.split()[0] for x in KEYS.split(", ")])

    @frugal
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, grams, size = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                docs.append(doc)
                grams.append(shingles(words(text.as_py())[0]))
                size += len(grams[-1])
                if size >= BATCH:
                    yield combine(docs, grams)
                    docs, grams, size = [], [], 0
        if docs:
            yield combine(docs, grams)

    return texts.select("doc", "text").mapInArrow(make, KEYS)


def candidate_pairs(texts: DataFrame, least: int, threshold: float) -> DataFrame:
    """Distinct ``doc`` and ``y_doc``: each document with the first one that has a signature of it.

    Runs of two lengths are taken. The short ones are those that every passage has word for word, whatever its changes;
    the long ones are whole passages, whose signatures a sentence or line in common does not have. A signature that
    many documents have is dealt into parts: a document meets the first of its part, and that one the first of all.
    """
    lengths = tuple(sorted({seed_grams(least, threshold), least}))
    keys = _keys(texts, lengths, common_signatures(texts, lengths))
    first = F.first("doc").over(W.partitionBy("key").orderBy("doc").rowsBetween(W.unboundedPreceding, 0))
    met = keys.withColumn("y_doc", first).where("doc > y_doc or common is not null").select("doc", "y_doc", "common").distinct()
    met = materialise(met, "met")
    parts = met.where("common is not null").select("common", F.col("y_doc").alias("doc")).distinct()
    across = parts.withColumn("y_doc", F.min("doc").over(W.partitionBy("common")))  # at most PARTS rows each
    return met.select("doc", "y_doc").unionByName(across.select("doc", "y_doc")).where("doc > y_doc").distinct()


def _places(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the grams of ``x`` that ``y`` has too, and for each its place in ``y``.

    Of several places in ``y`` the one counts that goes on from the gram before; else the one that keeps best to the shift
    of the nearest grams that ``y`` has once, before or after it; without any, the first.
    """
    order = np.argsort(y, kind="stable")
    ranked = y[order]
    lo, hi = np.searchsorted(ranked, x, "left"), np.searchsorted(ranked, x, "right")
    p = np.flatnonzero(hi > lo)
    if not len(p):
        return p, p
    lo, hi = lo[p], hi[p]
    q, single = order[lo], hi - lo == 1
    many = np.flatnonzero(~single)
    if len(many):
        where, size = np.arange(len(p)), len(y) + 1
        before = np.maximum.accumulate(np.where(single, where, -1))[many]
        after = np.minimum.accumulate(np.where(single, where, len(p))[::-1])[::-1][many]
        ordered = np.searchsorted(ranked, ranked, "left") * size + order  # ascending by gram, then by place
        best, off = q[many], np.full(len(many), len(x) + len(y))
        for near, some in ((before, before >= 0), (after, after < len(p))):
            near = np.clip(near, 0, len(p) - 1)
            wanted = np.clip(q[near] - p[near] + p[many], 0, len(y))
            right = np.searchsorted(ordered, lo[many] * size + wanted)
            for m in (right - 1, right):
                place = order[np.clip(m, lo[many], hi[many] - 1)]
                gap = np.abs(place - wanted)
                better = some & (gap < off)
                best, off = np.where(better, place, best), np.where(better, gap, off)
        q[many] = best
        next_to = (p[many] == p[many - 1] + 1) & (many > 0)
        found, last, grams, wanted = q.tolist(), len(y) - 1, y.tolist(), x[p[many]].tolist()
        for k, follows, gram in zip(many.tolist(), next_to.tolist(), wanted, strict=True):
            if follows and (w := found[k - 1]) < last and grams[w + 1] == gram:
                found[k] = w + 1
        q = np.array(found)
    return p, q


def _former(x: np.ndarray) -> np.ndarray:
    """The place before each place that has the same gram, or -1."""
    order = np.argsort(x, kind="stable")
    out = np.full(len(x), -1)
    same = x[order[1:]] == x[order[:-1]]
    out[order[1:][same]] = order[:-1][same]
    return out


def passages(x: np.ndarray, y: np.ndarray, least: int, threshold: float) -> list[tuple[int, int, int, int, float]]:
    """Passages of ``x`` (as runs of grams) that have a similar one in ``y``: begin, end, begin and end in y, similarity.

    The common grams are cut into runs without a gap or a change of shift. From each run the furthest later one is taken
    whose joined span is long and similar enough, unless an earlier span holds it. A bound of the similarity by counts,
    which is never below it, spares most sets.
    """
    if len(x) == len(y) and (x == y).all():
        return [(0, len(x) - 1, 0, len(y) - 1, 1.0)] if len(x) >= least else []
    p, q = _places(x, y)
    if not len(p):
        return []
    begins = np.flatnonzero(np.r_[True, (np.diff(p) != 1) | (np.diff(q) != 1)])
    ends = np.r_[begins[1:], len(p)] - 1
    at, to, y_at, y_to = p[begins], p[ends], q[begins], q[ends]
    # a span has at least as many distinct grams as stand there for the first time; the best end for each begin by that
    former, former_y = _former(x), _former(y)
    new_x, new_y = (np.r_[0, np.cumsum(f < 0)] for f in (former, former_y))
    by_end, by_begin = ends + 1 - threshold * new_x[to + 1], begins - threshold * new_x[at]
    best = np.r_[np.maximum.accumulate(by_end[::-1])[::-1], -np.inf]
    near = np.maximum(np.searchsorted(to, at + least - 1), np.arange(len(at)))
    some = np.flatnonzero(best[near] >= by_begin - 1e-9)
    shift, held = y_at - at, former[p]
    out, reached = [], -1
    for i in some.tolist():
        low = max(int(near[i]), reached + 1)
        if low >= len(at):
            break
        js = low + np.flatnonzero(by_end[low:] >= by_begin[i] - 1e-9)
        if not len(js):
            continue
        a, stop = int(at[i]), js[-1] + 1
        close = np.abs(shift[i:stop] - shift[i]) <= np.maximum(least // 2, (to[i:stop] - a) // 4)
        js = js[close[js - i]]
        c = np.minimum.accumulate(np.where(close, y_at[i:stop], len(y)))[js - i]
        d = np.maximum.accumulate(np.where(close, y_to[i:stop], -1))[js - i]
        mine = np.cumsum(former[a : to[stop - 1] + 1] < a)[to[js] - a]
        common = np.cumsum(held[begins[i] : ends[stop - 1] + 1] < a)[ends[js] - begins[i]]
        may = (d - c + 1 >= threshold * least) & (common * (1 + threshold) >= threshold * (mine + new_y[d + 1] - new_y[c]) - 1e-9)
        for j, n, yc, yd in zip(js[may][::-1].tolist(), mine[may][::-1].tolist(), c[may][::-1].tolist(), d[may][::-1].tolist(), strict=True):
            b = int(to[j])
            other = np.sort(y[yc : yd + 1][former_y[yc : yd + 1] < yc])
            own = x[a : b + 1][former[a : b + 1] < a]
            both = int((other[np.minimum(np.searchsorted(other, own), len(other) - 1)] == own).sum())
            similar = both / (n + len(other) - both)
            if similar >= threshold:
                out.append((a, b, yc, yd, similar))
                reached = j
                break
    return out


FOUND = "doc long, start long, end long, n_words long, first_doc long, similarity double"


def verified(pairs: DataFrame, texts: DataFrame, least: int, threshold: float) -> DataFrame:
    """Passages of each ``doc`` of the pairs in its ``y_doc``.

    The documents of an earlier one are dealt into turns, of ``FAN`` documents for the one with the most; its text goes to
    each turn that has any. Texts stream through the tasks in the order of the earlier documents, which come first.
    """
    most = pairs.groupBy("y_doc").count().agg(F.max("count")).first()[0] or 1
    dealt = pairs.withColumn("turn", F.pmod(F.xxhash64("doc"), F.lit(-(-most // FAN))))
    originals = dealt.select("y_doc", "turn").distinct().withColumn("doc", F.col("y_doc"))
    rows = dealt.withColumn("later", F.lit(1)).unionByName(originals.withColumn("later", F.lit(0)))
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a merge join at every size: the pairs grow with the texts, and a plan that broadcasts them holds for small inputs only
    sent = rows.hint("merge").join(texts, "doc").repartition(parts, "y_doc", "turn").sortWithinPartitions("y_doc", "turn", "later")

    @frugal
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, earlier = None, []
        for batch in batches:
            found = []
            for y_doc, turn, doc, later, text in zip(*(batch.column(k).to_pylist() for k in range(4)), batch.column(4), strict=True):
                if now != (y_doc, turn):
                    now, earlier = (y_doc, turn), []
                hashes, start, end = words(text.as_py())
                x = shingles(hashes)
                if not later:
                    earlier.append(x)
                    continue
                for y in earlier:
                    for a, b, _c, _d, similar in passages(x, y, least, threshold):
                        last = min(b + SHINGLE, len(start)) - 1
                        found.append((doc, int(start[a]), int(end[last]), last - a + 1, y_doc, similar))
            columns = zip(*found, strict=True) if found else [[]] * 6
            kinds = [pa.int64()] * 5 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in FOUND.split(", ")])

    return sent.select("y_doc", "turn", "doc", "later", "text").mapInArrow(verify, FOUND)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """Passages of at least ``least_words`` words that an earlier document (smaller id) has too, exactly or nearly.

    One row for each passage and earlier document: ``doc``, ``start`` and ``end`` (characters), ``n_words``,
    ``first_doc`` and ``similarity`` (Jaccard of the passages' five-word shingles, at least ``threshold``).

    Two documents with such a passage in common have a signature in common always (``seed_grams``). A document is
    compared with the first that has a signature, at two lengths of runs, so that a passage of m documents makes m pairs
    and not m squared; which documents meet depends on ids and texts alone. A passage is lost only if for each of its signatures the
    first document with it has no such passage: the README states how often that happens.

    Null, empty and short texts have no passages, rows with a null id take no part, and passages that repeat within one
    document only are left alone. Rows that share an id are one document with several texts. Other columns are ignored.
    An empty table gives an empty result.
    """
    least = max(1, least_words - SHINGLE + 1)
    texts = _rows(docs, id_col, text_col)
    pairs = materialise(candidate_pairs(texts, least, threshold), "pairs")
    found = materialise(verified(pairs, texts, least, threshold).distinct(), "passages")
    discard(pairs)
    return found


def cut_passages(docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the characters of their passages, once each where they overlap; every row and column stays."""

    names = docs.columns

    @frugal
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column("__text").to_pylist(), batch.column("__spans").to_pylist(), strict=True):
                for at, end in _merged(spans or ())[::-1]:
                    text = text[:at].rstrip(" ") + " " * bool(text[:at].strip() and text[end:].strip()) + text[end:].lstrip(" ") if text else text
                texts.append(text)
            columns = [pa.array(texts, pa.string()) if n == text_col else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    spans = passages.groupBy(F.col("doc").alias("__id")).agg(F.collect_set(F.array("start", "end")).alias("__spans"))
    joined = docs.join(spans.hint("merge"), F.col(id_col) == F.col("__id"), "left")
    return joined.select(*docs.columns, F.col(text_col).alias("__text"), "__spans").mapInArrow(cut, docs.schema)


def _merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(map(tuple, spans)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]
