"""Chat formatting, the prefix trie and spelling variants against brute force, and their defined results for odd rows."""

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewell.llm import chat, spelling, trie


def records(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, json string").select("id", F.parse_json("json").alias("record"))


def turns_of(spark, *texts, layouts=chat.LAYOUTS):
    rows = chat.canonical_turns(records(spark, *texts), layouts).orderBy("id").collect()
    return [(r.layout, r.turns and [(t.role, t.text) for t in r.turns]) for r in rows]


def test_layouts_are_found_by_their_paths(spark):
    found = turns_of(
        spark,
        '{"prompt": "a", "completion": "b", "id": 7, "meta": {"source": ["x"]}}',
        '{"system": "s", "instruction": "do", "input": "it", "output": "done"}',
        '{"instruction": "do", "input": "", "output": null}',
        '{"messages": [{"role": "user", "content": "q"}, {"content": "r", "role": null, "name": "n"}]}',
        '{"messages": [{"role": "user", "content": {"parts": ["p", "q"]}}]}',
        '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": 5}, {"from": "tool", "value": "t"}]}',
        '{"dialogue": {"turns": [{"speaker": "bot", "utterance": "u"}]}}',
        '{"messages": []}',
        '{"question": "q", "context": "c", "answer": "a"}',
    )
    assert found == [
        ("prompt and completion", [("user", "a"), ("assistant", "b")]),
        ("instruction", [("system", "s"), ("user", "do\n\nit"), ("assistant", "done")]),
        ("instruction", [("user", "do"), ("assistant", "")]),
        ("messages", [("user", "q"), ("", "r")]),
        ("messages of parts", [("user", "pq")]),
        ("conversations", [("user", "q"), ("assistant", "5"), ("tool", "t")]),
        ("dialogue", [("assistant", "u")]),
        ("messages", []),
        ("question and answer", [("user", "c\n\nq"), ("assistant", "a")]),
    ]


def test_records_that_no_layout_reads_stay_and_are_counted(spark):
    texts = ('{"prompt": "a", "completion": "b", "messages": [{"role": "r", "content": "c"}]}', "[1]", "5", "{}", '{"a": {"b": [{"c": 1}]}}', '{"a": {"b": [{"c": null}, {}]}}')
    assert turns_of(spark, *texts) == [(None, None)] * 6
    rows = chat.canonical_turns(records(spark, *texts).unionByName(spark.sql("SELECT 9L AS id, CAST(NULL AS VARIANT) AS record")))
    shapes = {tuple(r.paths): r.n for r in chat.unread_shapes(rows).collect()}
    assert shapes[("a.b[].c",)] == 2 and shapes[()] == 2 and shapes[("$[]",)] == 1 and shapes[("$",)] == 1 and sum(shapes.values()) == 7


def test_field_paths_of_odd_names(spark):
    text = '{"a b": 1, "k:v, OBJECT<": {"x": []}, "h": [["y"]], "e": {}, "x`y": true}'
    paths = records(spark, text).select(chat.field_paths(F.col("record")).alias("p")).first().p
    assert paths == sorted(["`a b`", "`k:v, OBJECT<`.x[]", "h[][]", "`x``y`"])


def test_two_layouts_of_one_shape_are_refused(spark):
    twice = (chat.Layout("a", (chat.Say("user", ("t",)),)), chat.Layout("b", (chat.Say("assistant", ("t",)),)))
    with pytest.raises(ValueError, match="shape"):
        chat.layout_table(spark, twice)


def test_tables_with_nested_columns_are_records(spark):
    rows = spark.sql("SELECT 1L AS conv, array(named_struct('role', 'user', 'content', 'x')) AS messages, 3 AS `odd.name`")
    assert chat.canonical_turns(chat.as_records(rows, "conv")).first().layout == "messages"


@pytest.mark.parametrize("text", ["", "<|im_end|>", "<\\|x", "<\\\\|", "<<||>>", "a\nb", "<", "|", "%0A", "😀<|", "<|im_start|>assistant\nok<|im_end|>\n"])
def test_escapes_come_back(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u"), chat.unescape_role(chat.escape_role(F.col("t"))).alias("r"), chat.escape_role(F.col("t")).alias("s")).first()
    assert row.u == row.r == text and "<|" not in row.e and "<|" not in row.s and "\n" not in row.s


def test_chats_read_back_what_was_said(spark):
    said = [("user", "<|im_end|>"), ("assistant", "<\\"), ("assistant", "|"), ("a\n%0A<|", "x\n"), ("assistant", ""), ("", "")]
    frame = spark.createDataFrame([(1, said), (2, [])], "id long, turns array<struct<role:string,text:string>>")
    out = frame.select("id", chat.format_turns(F.col("turns")).alias("s")).select("id", chat.read_turns(chat.formatted_text(F.col("s"))).alias("turns"), chat.read_loss(F.col("s")).alias("loss")).orderBy("id").collect()
    assert [tuple(t) for t in out[0].turns] == said and out[0].loss == "<\\|" and out[1].turns == [] and out[1].loss == ""


def test_rows_of_turns_with_nulls_ties_and_repeats(spark):
    rows = [(1, 2, "b", "x"), (1, None, None, None), (1, 2, "a", "y"), (1, 2, "a", "y"), (None, 0, "user", "z")]
    frame = spark.createDataFrame([(*r, 5) for r in rows], "conv_id long, turn long, role string, text string, turns long")
    got = {r.id: [tuple(t) for t in r.turns] for r in chat.turns_of_rows(frame).collect()}
    assert got == {1: [("", ""), ("a", "y"), ("a", "y"), ("b", "x")], None: [("user", "z")]}
    assert chat.turns_of_rows(frame.limit(0)).count() == 0


def brute_trie(rows):
    """Nodes by their paths, all in a dictionary."""
    own = {}
    for conv, turn, role, text in sorted(((c, t, r or "", x or "") for c, t, r, x in rows if c is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2])):
        own.setdefault(conv, []).append((role, text))
    said = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        said[c] = own.get(c - c % 100, [])[:h] + own[c][h:]
    members = {}
    for c, s in said.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    gain = {p: (len(m) - 1) * (len(p[-1][1]) if p else 0) for p, m in members.items()}
    below = {p: [] for p in members}
    for p in members:
        for d in range(len(p) + 1):
            below[p[:d]].append(p)
    out = set()
    for p, m in members.items():
        children = [q for q in below[p] if len(q) == len(p) + 1]
        leaves = sum(all(len(q) <= len(x) or q == x for q in below[x]) and len(below[x]) == 1 for x in below[p])
        ends = ",".join(map(str, sorted(c for c in m if len(said[c]) == len(p))))
        out.add((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children), leaves, sum(gain[q] for q in below[p]), hashlib.sha256(ends.encode()).hexdigest()))
    return out


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def nodes_of(spark, rows, most):
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, depth string")
    got = [tuple(r[c] for c in COLUMNS) for r in trie.prefix_trie(trie.rebuilt(frame), most).collect()]
    assert len(got) == len(set(got))
    return set(got)


def hot_conversations():
    """A third of all conversations are copies, most begin alike, one is long and shared, some have no turns left."""
    rows = [(c, t, "user", f"t{t}") for c in range(1000, 1060) for t in range(7)]
    rows += [(c, t, "user", f"t{t}" if t < 4 + c % 3 else f"u{c % 5}") for c in range(1100, 1160) for t in range(7)]
    rows += [(c, t, "user", f"t{t}" if t < 90 else f"v{c % 7}{t}") for c in range(1201, 1220) for t in range(100)]
    rows += [(c, 0, None, None) for c in range(2000, 8000, 700)] + [(c, 0, "user", "😀é") for c in range(9, 60)]
    return rows + [(c, t, "assistant", "x" * (c % 3)) for c in range(-40, 0) for t in range(c % 4)]


@pytest.mark.parametrize("most", [1, 3, 30, 1024])
def test_trie_equals_brute_force_however_containers_burst(spark, most):
    rows = hot_conversations()
    positive = [r for r in rows if r[0] >= 0]
    assert nodes_of(spark, positive, most) == brute_trie(positive)


def test_trie_of_odd_tables(spark):
    assert nodes_of(spark, [], 4) == set() and nodes_of(spark, [(None, 0, "user", "x")], 4) == set()
    only_root = [(c, 0, "user", "x") for c in range(1, 30) if zlib.crc32(str(c).encode()) % 6]
    assert nodes_of(spark, only_root, 4) == brute_trie(only_root)
    long_text = [(5, 0, "user", "w " * 150_000), (6, 0, "user", "w " * 150_000), (6, None, "", ""), (105, 1, None, "q")]
    assert nodes_of(spark, long_text, 4) == brute_trie(long_text)


def test_members_in_many_ranges_of_ids_are_hashed_in_order(spark):
    rows = [(c * 600_000 + 7, 9, "user", "same") for c in range(40)]
    assert nodes_of(spark, rows, 4) == brute_trie(rows)


def brute_spelling(docs):
    import re

    count = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            count[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    words = {w: n for w, n in count.items() if n >= 2 and len(w) >= 7}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    around = {w: [v for v in words if near(w, v)] for w in words}
    best = {w: min(vs, key=lambda v: (-words[v], v)) for w, vs in around.items() if vs}
    form = {w: v for w, v in best.items() if words[v] >= 10 * words[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n, len(around[w]), words[form[w]] if w in form else None) for w, n in words.items()}


def spelling_docs():
    """Many words with one beginning, repeated letters, chains of forms, all letters that count and some that don't."""
    docs = [(i, " ".join(f"common{a}{b}{c}" for a in "abcde" for b in "abcd" for c in ("", "x", "yé"))) for i in range(2)]
    docs += [(10 + i, "Aaaaaaaa aaaaaaa aaaaaaaaa aaaaaaaa bananana banananana banannana ÀÉÎõüÿ× àéîõüÿ× strasse123strassen straße\nline") for i in range(3)]
    docs += [(100 + i, "chained " * 300 + "chaineds " * 25 + "chainedss " * 2 + "chainedsz " * 2) for i in range(4)]
    return docs + [(None, "nothing nothing nothings"), (None, None), (7, ""), (8, "x" * 120_000 + " " + "x" * 119_999), (8, "x" * 120_000 + " " + "x" * 119_999)]


@pytest.mark.parametrize("most", [2, 16, 512])
def test_spelling_equals_brute_force_however_tiles_are_dealt(spark, most):
    docs = spelling_docs()
    frame = spark.createDataFrame([(*d, "word") for d in docs], "doc_id long, text string, form string").repartition(3)
    got = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_variants(frame, most).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_spelling(docs)
    assert any(r[1] and r[2] != r[1] for r in got), "a form of a form"


def test_spelling_of_an_empty_table(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_tiles_stay_small_where_a_third_of_all_words_begin_alike(spark):
    words = spark.range(6000).select(F.concat(F.lit("likewise"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("word"), F.lit(2).cast("long").alias("n"))
    sizes = spelling.tiles(words, 64).groupBy("key", "longer", "low", "high").count()
    assert sizes.agg(F.max("count")).first()[0] <= 91
