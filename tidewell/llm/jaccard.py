"""N-gram Jaccard join: MinHash banding proposes, full sets of word n-grams decide."""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..tables import discard, materialise
from .words import SHINGLE, frugal, mix, shingle_set

#: Members of one verification block. A larger bucket or component is dealt into blocks and compared block by block.
BLOCK = 128
#: Rows that small buckets and components share in one verification group.
BIN = 256


def choose_bands(threshold: float, recall: float, hashes: int = 100) -> tuple[int, int]:
    """The most selective (bands, rows) within ``hashes`` hash functions that finds a pair at ``threshold`` with probability ``recall``."""
    for rows in range(hashes, 1, -1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))
        if bands * rows <= hashes:
            return bands, rows
    return hashes, 1


def band_hashes(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash for each band of the MinHash signature of a nonempty set."""
    salt = mix(np.arange(1, bands * rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    odd = mix(salt) | np.uint64(1)
    least = np.full(bands * rows, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(grams), 4096):
        part = grams[None, i : i + 4096] ^ salt[:, None]
        part *= odd[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    key = np.zeros(bands, dtype=np.uint64)
    for column in least.reshape(bands, rows).T:
        key = mix(key + column)
    return key + np.arange(bands, dtype=np.uint64)


def signatures(docs: DataFrame, id_col: str, text_col: str, n: int, bands: int, rows: int) -> DataFrame:
    """Columns ``id``, ``fp`` (fingerprint of the whole n-gram set, null if it is empty) and ``bands``."""

    @frugal
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, keys = [], []
            for text in batch.column(1):
                grams = shingle_set(text.as_py(), n)
                prints.append(xxhash.xxh3_128_digest(grams.tobytes()) if len(grams) else None)
                keys.append(band_hashes(grams, bands, rows).view(np.int64) if len(grams) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["id", "fp", "bands"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(sign, "id long, fp binary, bands array<long>")


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections; n-grams in one set only are left out first."""
    n = len(sets)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    first = np.r_[True, values[1:] != values[:-1]] if len(values) else np.empty(0, bool)
    column = np.cumsum(first) - 1
    shared = np.bincount(column)[column] > 1
    owner, column = owner[shared], column[shared]
    column = np.unique(column, return_inverse=True)[1]
    out = np.zeros((n, n), dtype=np.float64)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, (low, low + 4096))
        part = np.zeros((n, min(4096, int(column[-1]) + 1 - low)), dtype=np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        out += part @ part.T
    return out


def _groups(linked: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """For each row the first row it is connected with, and the edges of a spanning forest."""
    group, forest = np.full(len(linked), -1), []
    for root in range(len(linked)):
        if group[root] >= 0:
            continue
        group[root], todo = root, [root]
        while todo:
            x = todo.pop()
            for y in np.flatnonzero(linked[x] & (group < 0)).tolist():
                group[y] = root
                todo.append(y)
                forest.append((x, y))
    return group, forest


def verify_blocks(n: int, threshold: float):
    """For a verification group: each member's links counted in copies, and a spanning forest of the links."""

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        rep, print_, other, count = [], [], [], []
        for (_, turn, i, j), part in pdf.groupby(["key", "turn", "i", "j"], sort=False):
            part = part.drop_duplicates(["rep", "fp", "text"])
            sets = [shingle_set(t, n) for t in part["text"]]
            same = [xxhash.xxh3_128_digest(s.tobytes()) == f for s, f in zip(sets, part["fp"], strict=True)]  # else another text under this id
            part, sets = part[same], [s for s, ok in zip(sets, same, strict=True) if ok]
            once = (~part.duplicated(["rep", "fp"])).tolist()
            part, sets = part[once], [s for s, ok in zip(sets, once, strict=True) if ok]
            if len(sets) < 2:
                continue
            ids, copies, block = part["rep"].to_numpy(), part["copies"].to_numpy(), part["block"].to_numpy()
            both, sizes = _overlaps(sets), np.array([len(s) for s in sets], dtype=np.float64)
            linked = both >= threshold * (sizes[:, None] + sizes[None, :] - both) - 1e-9
            linked[ids[:, None] == ids[None, :]] = False  # itself, and other texts under its id
            keys = np.stack(part["bands"].to_numpy())
            if turn < 0:  # a whole component: pairs that agree in a band, as in its buckets
                linked &= np.logical_or.reduce([keys[:, band, None] == keys[None, :, band] for band in range(keys.shape[1])])
            for band in range(turn):  # a pair of several buckets counts in that of its first common band
                linked &= keys[:, band, None] != keys[None, :, band]
            same_block = block[:, None] == block[None, :]
            counted = linked & same_block if i == j else linked & ~same_block
            total = counted @ copies
            rep += ids[total > 0].tolist()
            print_ += part["fp"][total > 0].tolist()
            other += [None] * int((total > 0).sum())
            count += total[total > 0].tolist()
            group, forest = _groups(linked & same_block)
            if i != j:  # what a block links by itself, the comparison with itself hands on
                x, y = np.nonzero(counted)
                pairs, at = np.unique(np.stack([group[x], group[y]]), axis=1, return_index=True)
                across = np.zeros((len(ids), len(ids)), dtype=bool)
                across[pairs[0], pairs[1]] = across[pairs[1], pairs[0]] = True
                where = {(int(p), int(q)): (int(x[k]), int(y[k])) for p, q, k in zip(*pairs, at, strict=True)}
                where |= {(q, p): v for (p, q), v in where.items()}
                forest = [where[e] for e in _groups(across)[1]]
            for x, y in forest:
                rep.append(ids[x])
                print_.append(None)
                other.append(ids[y])
                count.append(0)
        return pd.DataFrame({"rep": pd.array(rep, "Int64"), "fp": pd.Series(print_, dtype=object), "other": pd.array(other, "Int64"), "links": pd.array(count, "Int64")})

    return links


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE, threshold: float = 0.8, recall: float = 0.9995) -> DataFrame:
    """All links between texts whose sets of word n-grams have a Jaccard similarity of at least ``threshold``.

    Returns one row for each id: ``id``, ``class_id`` (the smallest id reachable over links, itself included),
    ``n_links`` (other documents linked directly, copies counted one by one) and ``kept`` (``id = class_id``).

    * Documents with the same n-gram set collapse into one representative before anything is compared.
    * Pairs of representatives that agree in a band are compared by their full sets, each once. They meet in the buckets of
      their bands (a pair of several buckets counts in that of its first common band; of buckets with the same members
      only the first is kept), or, where that moves fewer rows, in the whole component that the buckets make: near copies
      of one text share most of their buckets, while chance collisions chain up texts that share few. The links are the
      same either way. Buckets and components of more than ``BLOCK`` members are compared block by block; only counts and
      a spanning forest leave a block.
    * A text of fewer than n words is one n-gram of all its words. Null, empty and wordless texts have no links and are
      classes of their own. Rows that share an id count as one document with the links of all of them; rows with a
      null id have null results. Other columns are ignored. An empty table gives an empty result.
    """
    bands, rows = choose_bands(threshold, recall)
    signed = materialise(signatures(docs, id_col, text_col, n, bands, rows), "signed")
    sets = signed.where("fp is not null and id is not null")
    classes = sets.groupBy("fp").agg(F.min("id").alias("rep"), F.countDistinct("id").alias("copies"), F.first("bands").alias("bands"))
    classes = materialise(classes, "classes")

    members = classes.select("rep", F.posexplode("bands").alias("turn", "key"))
    who = [F.bit_xor(F.xxhash64("rep", F.lit(salt))).alias(f"who{salt}") for salt in (1, 2)]
    buckets = members.groupBy("key", "turn").agg(F.count("*").alias("size"), F.min("rep").alias("least"), *who).where("size > 1")
    first = F.min(F.struct("turn", "key")).alias("bucket")
    buckets = materialise(buckets.groupBy("size", "least", "who1", "who2").agg(first).select("size", "least", "bucket.*"), "buckets")
    member = members.join(buckets, ["key", "turn"]).select("rep", "key", "turn", "size", "least")
    components = materialise(connected_components(member.select("rep", "least"), "rep", "least"), "components")
    rows = lambda size: F.ceil(size / BLOCK) * size  # noqa: E731  a member goes to as many pairs of blocks as there are blocks
    by_bucket = buckets.join(components.withColumnRenamed("id", "least"), "least").groupBy("component").agg(F.sum(rows(F.col("size"))).alias("apart"))
    way = components.groupBy("component").agg(F.count("*").alias("members")).join(by_bucket, "component").withColumn("whole", rows(F.col("members")) <= F.col("apart"))
    way = materialise(way, "ways")
    total = way.agg(F.sum("members")).first()[0] or 0

    whole = components.join(way.where("whole"), "component").select(F.col("id").alias("rep"), F.col("component").alias("key"), F.lit(-1).alias("turn"), F.col("members").alias("size"))
    apart = components.join(way.where("not whole").select("component"), "component").select(F.col("id").alias("rep"))
    dealt = whole.unionByName(member.join(apart, "rep").select("rep", "key", "turn", "size")).withColumn("blocks", F.ceil(F.col("size") / BLOCK))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("rep"), "blocks")).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("rep", "key", "turn", "block", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "blocks")
    bins = max(1, total // BIN)
    dealt = dealt.withColumn("bin", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("key"), F.lit(bins))).otherwise(F.xxhash64("key", "turn", "i", "j")))
    wanted = dealt.join(classes.select("rep", "fp", "copies", "bands"), "rep")
    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text")).where("text is not null")
    found = wanted.join(texts, "rep").groupBy("bin").applyInPandas(verify_blocks(n, threshold), "rep long, fp binary, other long, links long")
    found = materialise(found, "links")

    linked = found.where("other is null").groupBy("rep", "fp").agg(F.sum("links").alias("links"))
    merged = connected_components(found.where("other is not null"), "rep", "other").withColumnRenamed("id", "rep")
    per_class = classes.select("fp", "rep", "copies").join(linked, ["rep", "fp"], "left").join(merged, "rep", "left")
    per_class = per_class.select("fp", F.coalesce("component", "rep").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = signed.select("id", "fp").distinct().join(per_class, "fp", "left").groupBy("id").agg(F.min("class_id").alias("class_id"), F.sum("n_links").alias("n_links"))
    out = out.select("id", F.coalesce("class_id", "id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return out.withColumn("kept", F.col("id") == F.col("class_id"))


def keep_one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: float) -> DataFrame:
    """The rows of ``docs`` without those documents that link to a class with a smaller id; rows with a null id stay."""
    gone = ngram_jaccard_join(docs, id_col, text_col, **options).where("not kept").select(F.col("id").alias(id_col))
    return docs.join(gone, id_col, "left_anti").select(docs.columns)
