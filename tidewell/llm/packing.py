"""Best-fit packing of documents into sequences, with lower bounds that certify each partition's count."""

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import discard, materialise
from .bpe import document_ids, encoder
from .words import frugal

CAPACITY = 2048
#: Pieces of a partition in the first round, and at most; each later round has groups of twice as many.
PIECES, MOST_PIECES = 4096, 65_536
#: Tokens that a sequence of a certified partition may have free without going to the exchange.
FREE = 16


PIECE = "id long, piece int, start long, length long, ids_crc32 long, row long"


def cut_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` ids: ``id``, ``piece``, ``start``, ``length``, ``ids_crc32``. The first piece of a longer document may be shorter.

    ``row`` numbers the rows, so that those with equal or null ids are dealt apart.
    """

    @frugal
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, row = encoder(tokenizer), TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = []
            for row, (name, text) in enumerate(zip(batch.column(0), batch.column(1), strict=True), row + 1):  # noqa: B020
                ids = document_ids(encode, text.as_py())
                edges = [0, *range(len(ids) - (len(ids) - 1) // capacity * capacity, len(ids) + 1, capacity)]
                rows += [(name.as_py(), k, a, b - a, zlib.crc32(ids[a:b].tobytes()), row) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in PIECE.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(cut, PIECE)


def bin_bound(count: np.ndarray, capacity: int) -> int:
    """No packing of ``count[length]`` pieces of each length has fewer bins: the largest of several dual-feasible functions' sums.

    A dual-feasible function maps lengths so that whatever fits into one bin maps to at most 1 in sum. Used are the
    lengths themselves; the threshold functions, which for some t count every length over capacity - t as a whole bin and
    leave out those under t; and the rounding functions, which for some k map x to floor((k + 1) x / capacity) / k unless
    (k + 1) x / capacity is whole.
    """
    size = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((count * size).sum()) // capacity)
    many, weight = np.cumsum(count), np.cumsum(count * size)
    t = np.arange(1, capacity // 2 + 1)
    large = many[-1] - many[capacity - t]  # over capacity - t
    middle = weight[capacity - t] - weight[t - 1]  # from t to capacity - t
    best = max(best, int((large + -(-middle // capacity)).max()))
    for k in range(1, 65):
        whole, rest = divmod((k + 1) * size, capacity)
        scaled = np.where(rest == 0, size * k, whole * capacity)  # times k * capacity
        best = max(best, -(-int((count * scaled).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and place in it of each length, longest first into the fullest bin that has room; and the number of bins."""
    bins, places = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, opened = 0, 0  # rooms: a bit for each room that some bin has
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        fits = rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            target = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, target, opened = capacity, opened, opened + 1
        bins[i], places[i] = target, capacity - room
        room -= length
        if room:
            if not by_room[room]:
                rooms |= 1 << room
            by_room[room].append(target)
    return bins, places, opened


PACKED = f"{PIECE}, part long, bin long, offset long, bins long, bound long, filled long"


def _pack(capacity: int):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "id", "piece", "row"], ascending=False, na_position="last")
        lengths = pdf["length"].to_numpy()
        bins, places, opened = best_fit_decreasing(lengths, capacity)
        filled = np.bincount(bins, lengths, opened).astype(np.int64)[bins]
        bound = bin_bound(np.bincount(lengths, minlength=capacity + 1).astype(np.int64), capacity)
        return pdf[[x.split()[0] for x in PIECE.split(", ")] + ["part"]].assign(bin=bins, offset=places, bins=opened, bound=bound, filled=filled)

    return pack


def _in_parts(pieces: DataFrame, parts: int, turn: int) -> DataFrame:
    part = F.pmod(F.xxhash64("row", "piece", F.lit(turn)), F.lit(parts))
    return pieces.withColumn("part", part + F.lit(turn << 32))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece of every document with its ``sequence_id`` and ``offset``, gapless from 0 in each sequence.

    Pieces are dealt evenly by a hash and packed by best-fit decreasing in each partition. A partition whose count equals
    its lower bound is certified; only its sequences with more than ``FREE`` tokens left go on. The others exchange all
    their documents: these are dealt anew into groups of twice the size and packed again, and the round counts if it saves
    sequences. Rounds end at the lower bound of all pieces together, when a round saves none, or when a group would have
    more than ``MOST_PIECES`` pieces, the most that a task holds. ``gap`` is the number of sequences that all have
    together above that bound.

    Null and empty texts are the end id alone. Rows that share an id stay separate pieces. Null ids stay null. Other
    columns are ignored. An empty table gives an empty result.
    """
    pieces = materialise(cut_documents(docs, tokenizer, capacity, id_col, text_col), "pieces")
    count = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in pieces.groupBy("length").count().collect():  # a row for each length up to the capacity
        count[length] = n
    least, left = bin_bound(count, capacity), int(count.sum())
    done: list[DataFrame] = []
    open_before, total = None, 0
    todo, size = pieces, PIECES
    for turn in itertools.count():
        parts = -(-left // size) or 1
        packed = materialise(_in_parts(todo, parts, turn).groupBy("part").applyInPandas(_pack(capacity), PACKED), "packed")
        goes_on = "(bins > bound OR filled < {})".format(capacity - FREE)
        firsts = packed.where("offset = 0")  # one of each sequence
        made, open_bins = firsts.agg(F.count("*"), F.count_if(F.expr(goes_on))).first()
        if open_before is not None and made >= open_before:
            discard(packed)
            break
        total += made - (open_before or 0)
        if done:
            done[-1] = done[-1].where(f"NOT {goes_on}")
        done.append(packed)
        left = packed.where(goes_on).count()
        size *= 2
        if total <= least or parts == 1 or size > MOST_PIECES:
            break
        todo, open_before = packed.where(goes_on).select(*(x.split()[0] for x in PIECE.split(", "))), open_bins
    discard(pieces)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    sequence = F.col("part") * F.lit(1 << 24) + F.col("bin")
    return out.select("id", "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), "offset", F.lit(total - least).cast("long").alias("gap"))
