"""Conversation prefix trie as a burst trie: heads of shared prefixes, containers of suffixes under them, sorted and swept into nodes."""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..tables import discard, materialise
from .words import frugal

#: Distinct sequences of a container above which it bursts.
CONTAINER = 256
#: Bytes of a turn in a sequence: the MD5 of role and text, then the text's code points, so that a turn's length is at hand.
TURN = 20
#: Members of a sequence are carried in rows of one such range of ids each, which bounds a row.
IDS = 1024
#: The hash of no members at all.
NOBODY = hashlib.sha256(b"").hexdigest()


def turn_id(role: Column, text: Column) -> Column:
    """The id of a turn in hexadecimal digits; equal role and text, equal id."""
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.md5(said.cast("binary")), F.lpad(F.hex(F.length(text)), 8, "0"))


def conversations(turns: DataFrame) -> DataFrame:
    """``conv_id`` and ``said``, its turn ids in order of turn (null first; equal numbers by role and turn id)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = turns.where("conv_id IS NOT NULL").select("conv_id", F.struct("turn", role.alias("role"), turn_id(role, text).alias("id")).alias("said"))
    rows = said.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    return rows.select("conv_id", F.transform("said", lambda s: s["id"]).alias("said"))


def rebuilt(turns: DataFrame, family: int = 100, most: int = 6) -> DataFrame:
    """``conv_id`` and ``seq``: the first h turns of the family's first conversation, then the conversation's own turns after its first h.

    The family of c begins at c - c % ``family``; h is the CRC-32 of the decimal c modulo ``most``. ``seq`` is the turns'
    ids, ``TURN`` bytes each, one after another; a conversation without turns has an empty one.
    """
    own = materialise(conversations(turns), "conversations")
    first = own.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("base"), F.slice("said", 1, most - 1).alias("begun"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    joined = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % family).withColumn("h", h).join(first, "base", "left")
    begun = F.slice(F.coalesce("begun", F.array().cast("array<string>")), F.lit(1), F.col("h"))
    rest = F.slice("said", F.col("h") + 1, F.greatest(F.size("said") - F.col("h"), F.lit(0)))
    return joined.select("conv_id", F.unhex(F.array_join(F.concat(begun, rest), "")).alias("seq"))


def _part(seq: str, n_turns: Column | int) -> Column:
    """The first turns of a sequence; all of it if it has fewer."""
    return F.substring(seq, F.lit(1), F.lit(TURN) * n_turns)


def _shared(a: Column, b: Column) -> Column:
    """How many turns two different sequences have in common at the beginning."""
    turns = [F.regexp_extract_all(F.hex(x), F.lit(f"[0-9A-F]{{{2 * TURN}}}"), F.lit(0)) for x in (a, b)]
    return (F.array_position(F.zip_with(*turns, lambda x, y: x.eqNullSafe(y)), False) - 1).cast("int")


def grouped(convs: DataFrame) -> DataFrame:
    """``seq``, ``n``, ``conv`` (the smallest) and ``ids`` (ascending, with commas): equal sequences once for each range of ``IDS`` ids."""
    ids = F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",")
    return convs.groupBy("seq", F.expr(f"conv_id DIV {IDS}").alias("ids_of")).agg(F.count("*").alias("n"), F.min("conv_id").alias("conv"), ids.alias("ids")).drop("ids_of")


def containers(sequences: DataFrame, most: int = CONTAINER) -> DataFrame:
    """``sequences`` with ``head``: after how many turns the container of a sequence hangs under the trie's heads.

    All begin under the root, dealt by their first turn. A container of more than ``most`` different rows bursts: its head
    goes down to where its sequences part, at least one turn, and it is dealt anew by the next turn id. Each burst parts
    at least two sequences, so that there are as many rounds as partings on a path that more than ``most`` sequences
    share; only repetitions of one sequence, which are one node, are never parted.
    """
    open_, done = sequences.withColumn("head", F.lit(0)), []
    while True:
        key = _part("seq", F.col("head") + 1)
        big = open_.groupBy(F.md5(key).alias("key")).agg(F.count("*").alias("rows"), F.min("seq").alias("low"), F.max("seq").alias("high")).where(f"rows > {int(most)} AND low <> high")
        big = materialise(big.select("key", _shared(F.col("low"), F.col("high")).alias("to")), "burst")
        if big.isEmpty():
            discard(big)
            done.append(open_)
            break
        keyed = open_.withColumn("key", F.md5(key))
        done.append(keyed.join(big, "key", "left_anti").drop("key"))
        open_ = materialise(keyed.join(big, "key").withColumn("head", F.col("to")).drop("key", "to"), "open")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


_SWEPT = "at string, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long, ends string, kind string, path binary"
_FIELDS = ("at", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends", "kind", "path")


class _Node:
    """An open node of the sweep. Its children wait in ``rows`` until its smallest member is known."""

    __slots__ = ("chars", "conv", "n", "children", "leaves", "saved", "ends", "rows")

    def __init__(self, chars: int, conv: int):
        self.chars, self.conv, self.n, self.children, self.leaves, self.saved, self.ends, self.rows = chars, conv, 0, 0, 0, 0, None, []


def _common(a: bytes, b: bytes) -> int:
    """Turns that two sequences share at the beginning, by halving: compares of whole slices, no loop over bytes."""
    low, high = 0, min(len(a), len(b)) // TURN
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[: mid * TURN] == b[: mid * TURN] else (low, mid - 1)
    return low


@frugal
def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by sequence and smallest member, containers whole -> nodes below the heads, and a summary of each container.

    Kept at a time: the open path, the children of its nodes, and a batch.
    """
    key, was, top, path, out = None, b"", 0, [], {f: [] for f in _FIELDS}

    def row(*values: object) -> None:
        for f, v in zip(_FIELDS, values, strict=True):
            out[f].append(v)

    def close(depth: int) -> None:
        """Close the open nodes below ``depth``; path[0] stands for the head node that the container hangs under."""
        while len(path) - 1 > depth - top:
            node, up = path.pop(), path[-1]
            if not node.children:
                node.leaves = 1
            node.saved += (node.n - 1) * node.chars
            for child in node.rows:
                row(None, child[0], child[1], node.conv, *child[2:], "node", None)
            up.rows.append((top + len(path), node.conv, node.n, node.children, node.leaves, node.saved, node.ends.hexdigest() if node.ends else NOBODY))
            up.conv, up.n, up.children = min(up.conv, node.conv), up.n + node.n, up.children + 1
            up.leaves, up.saved = up.leaves + node.leaves, up.saved + node.saved

    def finish() -> None:
        """Nodes right under the head carry its prefix, since their parent is found elsewhere; so does the summary."""
        close(top)
        head, prefix = path[0], was[: top * TURN]
        at = hashlib.md5(prefix).hexdigest()
        for child in head.rows:
            row(at, child[0], child[1], None, *child[2:], "top", None)
        row(at, top, head.conv, None, head.n, head.children, head.leaves, head.saved, head.ends.hexdigest() if head.ends else None, "summary", prefix)

    for batch in batches:
        columns = [batch.column(c) for c in ("seq", "head", "n", "conv", "ids")]
        for seq, head, n, conv, ids in zip(*(c.to_pylist() for c in columns), strict=True):
            if key is None or seq[: (head + 1) * TURN] != key or head != top:
                if key is not None:
                    finish()
                key, top, path = seq[: (head + 1) * TURN], head, [_Node(0, conv)]
                keep = top
            else:
                keep = max(_common(was, seq), top)
                close(keep)
            for d in range(keep, len(seq) // TURN):
                path.append(_Node(int.from_bytes(seq[(d + 1) * TURN - 4 : (d + 1) * TURN], "big"), conv))
            last = path[-1]
            last.n, last.conv = last.n + n, min(last.conv, conv)
            if last.ends is None:
                last.ends = hashlib.sha256(ids.encode())
            else:
                last.ends.update(b"," + ids.encode())
            was = seq
            if len(out["depth"]) >= 20_000:
                yield pa.RecordBatch.from_pydict(out, schema=_arrow)
                for values in out.values():
                    values.clear()
    if key is not None:
        finish()
    if out["depth"]:
        yield pa.RecordBatch.from_pydict(out, schema=_arrow)


_TYPES = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
_arrow = pa.schema([(name, _TYPES[kind]) for name, kind in (f.split() for f in _SWEPT.split(", "))])


def _heads(summaries: DataFrame) -> DataFrame:
    """The nodes that containers hang under, and all above them, from the containers' summaries.

    ``at`` and ``up`` are hashes of a node's and of its parent's path. A container counts for each node of its path; sums
    are made before rows move, so that the root, which all have, is no hot key.
    """
    one = summaries.groupBy("path").agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("tops"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"), F.max("ends").alias("ends"))
    one = materialise(one, "hung")
    depth = (F.length("path") / TURN).cast("int")
    spread = one.select("*", F.md5("path").alias("hung"), F.explode(F.sequence(F.lit(0), depth)).alias("d")).withColumn("own", F.col("d") == depth)
    last = F.substring("path", F.lit(TURN) * F.col("d") - 3, F.lit(4))
    chars = F.when(F.col("d") > 0, F.conv(F.hex(last), 16, 10).cast("long")).otherwise(0)
    at, up = F.md5(_part("path", F.col("d"))), F.when(F.col("d") > 0, F.md5(_part("path", F.col("d") - 1)))
    steps = spread.select("hung", at.alias("at"), up.alias("up"), F.col("d").cast("long").alias("depth"), chars.alias("chars"), "own", "conv_id", "n_convs", "tops", "n_leaves", "saved", "ends")
    mine = lambda c: F.when(F.col("own"), F.col(c))
    nodes = steps.groupBy("at").agg(
        F.min("hung").alias("by"), F.max("up").alias("up"), F.max("depth").alias("depth"), F.max("chars").alias("chars"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.coalesce(F.sum(mine("tops")), F.lit(0)).alias("tops"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"), F.max(mine("ends")).alias("ends"),
    )
    nodes = materialise(nodes.withColumn("gain", F.when(F.col("depth") > 0, (F.col("n_convs") - 1) * F.col("chars")).otherwise(0)), "heads")
    below = nodes.where("up IS NOT NULL").groupBy(F.col("up").alias("at")).agg(F.count("*").alias("heads_below"))
    # What the heads themselves save counts for each node above them: on one path each, that of ``by``.
    saving = steps.select("at", "hung", "depth").join(nodes.select("at", "by", "gain"), "at")
    deeper = F.sum(F.when(F.col("by") == F.col("hung"), F.col("gain")).otherwise(0)).over(W.partitionBy("hung").orderBy(F.desc("depth")))
    gains = saving.select("at", deeper.alias("gain")).groupBy("at").agg(F.sum("gain").alias("gains"))
    parents = nodes.select(F.col("at").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(below, "at", "left").join(gains, "at").join(parents, "up", "left")
    children = F.col("tops") + F.coalesce("heads_below", F.lit(0))
    return out.select("at", "depth", "conv_id", "parent_conv_id", "n_convs", children.alias("n_children"), F.when(children == 0, 1).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"), (F.col("saved") + F.col("gains")).alias("saved"), F.coalesce("ends", F.lit(NOBODY)).alias("ends"))


def prefix_trie(convs: DataFrame, most: int = CONTAINER) -> DataFrame:
    """``conv_id``, ``seq`` (a row for each conversation) -> a row for each node of their trie.

    ``conv_id``: the smallest member; ``depth``; ``parent_conv_id``: the parent's smallest member (null for the root);
    ``n_convs``; ``n_children``; ``n_leaves``: childless nodes of the subtree; ``saved_tokens``: over the subtree, each
    node's (n_convs - 1) times its last turn's code points; ``ends_sha256``: of the ids, ascending and joined with commas,
    of the conversations that end here.

    Shards are partitions of whole containers; a task sorts its rows by sequence and sweeps them with the path that is open
    as its memory. However hot a first turn, its container bursts into smaller ones; copies of one sequence meet as rows of
    up to ``IDS`` ids, which a task hashes one after another, for SHA-256 has no other way. A null ``conv_id`` is no
    conversation. An empty table has no nodes, not even a root.
    """
    sequences = materialise(grouped(convs.where("conv_id IS NOT NULL")), "sequences")
    dealt = containers(sequences, most).select("seq", "head", "n", "conv", "ids").repartition(F.md5(_part("seq", F.col("head") + 1))).sortWithinPartitions("seq", "conv")
    swept = materialise(dealt.mapInArrow(_sweep, _SWEPT), "swept")
    heads = materialise(_heads(swept.where("kind = 'summary'")), "head-nodes")
    columns = ["depth", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    inner = swept.where("kind = 'node'").select("conv_id", "parent_conv_id", *columns)
    parents = heads.select("at", F.col("conv_id").alias("parent_conv_id"))
    tops = swept.where("kind = 'top'").drop("parent_conv_id").join(parents, "at").select("conv_id", "parent_conv_id", *columns)
    nodes = inner.unionByName(tops).unionByName(heads.select("conv_id", "parent_conv_id", *columns))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))
