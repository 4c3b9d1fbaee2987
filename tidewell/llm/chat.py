"""Chat formatting by schema fingerprints: nested field paths select a declared layout that reads a record's turns. DataFrame functions only."""

from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Marks of the template. No text can hold one: ``escape`` puts a backslash into every ``<|``.
START, END, MASKED = "<|im_start|>", "<|im_end|>\n", "assistant"
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Say:
    """One turn of a fixed role: the non-empty texts at ``paths``, with an empty line between them.

    Paths in ``optional`` may be absent; the turn is left out if all of its paths are.
    """

    role: str
    paths: tuple[str, ...]
    optional: tuple[str, ...] = ()

    def fields(self) -> tuple[set[str], set[str]]:
        return set(self.paths) - set(self.optional), set(self.optional)

    def read(self, record: Column) -> Column:
        texts = F.array(*(_text_at(record, p) for p in self.paths))
        said = F.array_join(F.filter(texts, lambda t: t != ""), "\n\n")
        one = F.array(F.struct(F.lit(self.role).alias("role"), said.alias("text")))
        if set(self.paths) - set(self.optional):
            return one
        there = F.lit(False)
        for p in self.paths:
            there |= F.try_variant_get(record, f"$.{p}", "variant").isNotNull()
        return F.when(there, one).otherwise(F.array().cast(TURNS))


@dataclass(frozen=True)
class Each:
    """A turn for each element of the list at ``at``; ``role`` and ``text`` are paths inside of an element.

    A ``text`` that ends in ``[]`` is a list of parts, which are joined. ``roles`` renames roles; others stay.
    """

    at: str
    role: str
    text: str
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    def fields(self) -> tuple[set[str], set[str]]:
        return {f"{self.at}[].{self.role}", f"{self.at}[].{self.text}"}, set()

    def read(self, record: Column) -> Column:
        parts = self.text.endswith("[]")
        items = F.coalesce(F.try_variant_get(record, f"$.{self.at}", "array<variant>"), F.array().cast("array<variant>"))

        def turn(item: Column) -> Column:
            role = _text_at(item, self.role)
            for old, new in self.roles.items():
                role = F.when(_text_at(item, self.role) == old, new).otherwise(role)
            text = F.array_join(F.coalesce(F.try_variant_get(item, f"$.{self.text[:-2]}", "array<string>"), F.array().cast("array<string>")), "") if parts else _text_at(item, self.text)
            return F.struct(role.alias("role"), text.alias("text"))

        return F.transform(items, turn)


@dataclass(frozen=True)
class Layout:
    """How records of one shape become turns: the turns of ``parts``, one after another."""

    name: str
    parts: tuple[Say | Each, ...]

    def shapes(self) -> list[set[str]]:
        """The sets of leaf paths that this layout reads, with and without each optional path."""
        needed = set().union(*(p.fields()[0] for p in self.parts))
        optional = sorted(set().union(*(p.fields()[1] for p in self.parts)))
        return [needed | set(some) for n in range(len(optional) + 1) for some in combinations(optional, n)]

    def empty_shapes(self) -> list[set[str]]:
        """The same with empty lists, which have no paths inside."""
        lists = [p.at for p in self.parts if isinstance(p, Each)]
        return [{p for p in shape if not p.startswith(f"{at}[]")} | {f"{at}[]"} for at in lists for shape in self.shapes()]


_SYSTEM = Say("system", ("system",), ("system",))
#: The layouts that are known unless a caller declares others.
LAYOUTS = (
    Layout("prompt and completion", (_SYSTEM, Say("user", ("prompt",)), Say("assistant", ("completion",)))),
    Layout("prompt and response", (_SYSTEM, Say("user", ("prompt",)), Say("assistant", ("response",)))),
    Layout("question and answer", (_SYSTEM, Say("user", ("context", "question"), ("context",)), Say("assistant", ("answer",)))),
    Layout("instruction", (_SYSTEM, Say("user", ("instruction", "input"), ("input",)), Say("assistant", ("output",)))),
    Layout("messages", (Each("messages", "role", "content"),)),
    Layout("messages of parts", (Each("messages", "role", "content.parts[]"),)),
    Layout("conversations", (_SYSTEM, Each("conversations", "from", "value", {"human": "user", "gpt": "assistant"}))),
    Layout("dialogue", (Each("dialogue.turns", "speaker", "utterance", {"bot": "assistant"}),)),
)


def _text_at(record: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(record, f"$.{path}", "string"), F.lit(""))


def field_paths(record: Column) -> Column:
    """The distinct paths of the leaves of a variant, sorted: ``messages[].role`` for the roles in a list of objects.

    Values don't matter: a null is a leaf, and so is the missing element of an empty list (``messages[]``). An object
    without fields and a null record have no leaves; a record that is no object is ``$``. Names that aren't plain words
    stand in backquotes.
    """
    name = r"(?:`(?:[^`]|``)*`|[^\s`<>:,]+): "
    tokens = F.regexp_extract_all(F.schema_of_variant(record), F.lit(rf"({name}|OBJECT<|ARRAY<|>|[A-Z_]+(?:\([0-9, ]*\))?)"), 1)
    strings = "array<string>"
    begin = F.struct(F.array(F.lit("$")).alias("open"), F.lit("$").alias("at"), F.array().cast(strings).alias("found"))

    def read(state: Column, token: Column) -> Column:
        opened, at, found = state["open"], state["at"], state["found"]
        top = F.element_at(opened, -1)
        is_name, inside = token.endswith(": "), F.concat(at, F.lit("[]"))
        key = F.substring(token, F.lit(1), F.length(token) - 2)
        return F.struct(
            F.when(token == "OBJECT<", F.array_append(opened, at)).when(token == "ARRAY<", F.array_append(opened, inside)).when(token == ">", F.slice(opened, F.lit(1), F.size(opened) - 1)).otherwise(opened).alias("open"),
            F.when(is_name, F.when(top == "$", key).otherwise(F.concat(top, F.lit("."), key))).when(token == "ARRAY<", inside).otherwise(at).alias("at"),
            F.when(is_name | token.isin("OBJECT<", "ARRAY<", ">"), found).otherwise(F.array_append(found, at)).alias("found"),
        )

    paths = F.aggregate(tokens, begin, read, lambda s: F.array_sort(F.array_distinct(s["found"])))
    return F.coalesce(paths, F.array().cast(strings))


def fingerprint(paths: Column) -> Column:
    """A 64-bit hash of a sorted list of field paths."""
    return F.xxhash64(F.array_join(paths, "\n"))


def layout_table(spark: SparkSession, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """``fingerprint`` and ``layout`` for every shape that a layout reads; two layouts for one shape are an error.

    Empty lists are the same to all layouts that have the list: the first one gets them.
    """
    shapes: dict[str, str] = {}
    for layout in layouts:
        for shape in layout.shapes():
            if shapes.setdefault("\n".join(sorted(shape)), layout.name) != layout.name:
                raise ValueError(f"two layouts read records of the shape {sorted(shape)}")
    for layout in layouts:
        for shape in layout.empty_shapes():
            shapes.setdefault("\n".join(sorted(shape)), layout.name)
    every = F.lit(None).cast("array<struct<paths:string,layout:string>>") if not shapes else F.array(*(F.struct(F.lit(p).alias("paths"), F.lit(name).alias("layout")) for p, name in shapes.items()))
    return spark.range(1).select(F.inline(every)).select(F.xxhash64("paths").alias("fingerprint"), "layout")


def canonical_turns(records: DataFrame, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """``id``, ``record`` (a variant) -> ``id``, ``layout``, ``shape``, ``turns`` (role and text).

    The paths of a record that some layout reads are hashed; the hash selects the layout, so fields that no layout knows
    (ids, sources, scores) don't matter. ``shape`` hashes all paths. A record whose paths no layout reads, or that mixes
    two layouts, is kept with a null layout and null turns: ``unread_shapes`` counts these. Null texts and roles are empty.
    """
    # One row for each declared shape: as small as the declarations, whatever the records.
    table = F.broadcast(layout_table(records.sparkSession, layouts))
    known = sorted(set().union(*(shape for layout in layouts for shape in layout.shapes() + layout.empty_shapes())))
    out = records.select("id", "record").withColumn("paths", field_paths(F.col("record")))
    out = out.withColumn("fingerprint", fingerprint(F.array_intersect("paths", F.lit(known)))).join(table, "fingerprint", "left")
    turns = F.lit(None).cast(TURNS)
    for layout in layouts:
        turns = F.when(F.col("layout") == layout.name, F.concat(*(p.read(F.col("record")) for p in layout.parts))).otherwise(turns)
    return out.select("id", "layout", fingerprint(F.col("paths")).alias("shape"), turns.alias("turns"), F.when(F.col("layout").isNull(), F.col("paths")).alias("unread"))


def unread_shapes(turns: DataFrame) -> DataFrame:
    """``shape``, ``paths`` and ``n`` of the records that no layout reads: what to declare next."""
    return turns.where("layout IS NULL").groupBy("shape").agg(F.first("unread").alias("paths"), F.count("*").alias("n"))


def escape(text: Column) -> Column:
    """A backslash more between ``<`` and ``|``, wherever only backslashes or nothing stand between them."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    """Roles stand on a line of their own, so line breaks in them are written as %0A."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def format_turns(turns: Column, masked: str = MASKED) -> Column:
    """Segments (``text``, ``loss``) of a conversation: their texts in order are the formatted conversation.

    Only the texts of the role ``masked`` count for the loss: one segment each, also when empty; marks don't.
    """

    def piece(text: Column, loss: bool) -> Column:
        return F.struct(text.alias("text"), F.lit(loss).alias("loss"))

    def of(turn: Column) -> Column:
        head = F.concat(F.lit(START), escape_role(turn["role"]), F.lit("\n"))
        text = escape(turn["text"])
        return F.when(turn["role"] == masked, F.array(piece(head, False), piece(text, True), piece(F.lit(END), False))).otherwise(F.array(piece(F.concat(head, text, F.lit(END)), False)))

    return F.flatten(F.transform(turns, of))


def format_chats(records: DataFrame, layouts: Sequence[Layout] = LAYOUTS, masked: str = MASKED) -> DataFrame:
    """``id``, ``record`` -> ``id``, ``layout``, ``shape``, ``segments``; segments are null where no layout reads the record."""
    return canonical_turns(records, layouts).select("id", "layout", "shape", format_turns(F.col("turns"), masked).alias("segments"))


def formatted_text(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def read_turns(formatted: Column) -> Column:
    """The turns (role and text) of a formatted conversation."""
    pieces = F.split(formatted, r"<\|im_start\|>")

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        text = F.substring(piece, F.length(role) + 2, F.length(piece) - F.length(role) - 1 - len(END))
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def read_loss(segments: Column) -> Column:
    """All text under the loss mask; each segment is unescaped by itself, for two ends could look like an escape."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def as_records(rows: DataFrame, id_column: str) -> DataFrame:
    """Any table, whatever its nested columns, as ``id`` and ``record``: a variant of all other columns."""
    fields = [F.col(f"`{c.replace('`', '``')}`") for c in rows.columns if c != id_column]
    return rows.select(F.col(id_column).alias("id"), F.to_variant_object(F.struct(*fields)).alias("record"))


def turns_of_rows(rows: DataFrame) -> DataFrame:
    """Rows of one turn each (``conv_id``, ``turn``, ``role``, ``text``) -> ``id`` and ``turns`` in order of turn, null first.

    Turns with one number are ordered by role and text, null as empty. Repeated rows are turns of their own. Rows without
    a ``conv_id`` are one conversation with a null id. Other columns are ignored.
    """
    said = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = rows.select(F.col("conv_id").alias("id"), said.alias("said")).groupBy("id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    return grouped.select("id", F.transform("said", lambda s: F.struct(s["role"].alias("role"), s["text"].alias("text"))).alias("turns"))
