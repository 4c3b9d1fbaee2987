"""Null, empty, long, tied and repeated rows, extra columns and empty tables; results against brute force."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

pytest.importorskip("tidewell.llm")
public_tokenizers = pytest.importorskip("public_tokenizers")

from tidewell.llm import jaccard, langid, mixing, packing, quality, substring, tokenfile, wordpiece  # noqa: E402
from tidewell.llm.bpe import encoder  # noqa: E402
from tidewell.llm.words import shingle_set, words  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, bin string"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["ta", "ri", "mo", "len", "su", "da", "ko"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    base = prose(1, 120).split()
    near = [*base]
    near[60] = "changed"
    passage = prose(2, 55)
    return {
        1: " ".join(base), 2: " ".join(base), 3: " ".join(near), 4: None, 5: "", 6: "   \n ", 7: "one two three", 8: "One, two; three!", 9: prose(3, 4000), 10: prose(4, 80) + " " + passage + " " + prose(5, 90),
        11: prose(6, 70) + "\n" + passage + " " + prose(7, 60), 12: prose(8, 200), 13: "word " * 300, 14: "漢字 か　な  x\t\ty", 15: "".join(base),
    }


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, None if i % 5 == 0 else "en" if i % 2 else "fr", None if i == 3 else f"s{i % 3}", len(t or ""), 0.5, "x") for i, t in texts.items()]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _jaccard(a, b):
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    x, y = grams(split(a)), grams(split(b))
    return len(x & y) / len(x | y) if x and y else 0.0


def test_words_are_runs_of_letters_and_digits(texts):
    for t in texts.values():
        h, start, end = words(t)
        assert [(a, b) for a, b in zip(start, end, strict=True)] == [m.span() for m in re.finditer(r"[^\W_]+", t or "")]
    assert (words("AbC d")[0] == words("aBc D")[0]).all()
    assert len(shingle_set("a b c")) == 1 and len(shingle_set(None)) == 0


def test_jaccard_join_equals_brute_force(docs, texts):
    got = {r.id: r for r in jaccard.ngram_jaccard_join(docs).collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        assert got[i].n_links == sum(_jaccard(t, u) >= 0.8 for j, u in texts.items() if j != i), i
    assert [got[i].class_id for i in (1, 2, 3, 7, 8, 4, 5)] == [1, 1, 1, 7, 7, 4, 5]


def test_jaccard_join_splits_a_large_group_and_loses_no_link(spark):
    base = prose(11, 100).split()
    rows = []
    for i in range(300):
        w = list(base)
        w[i % 100] = f"x{i}"
        rows.append((i, " ".join(w)))
    got = {r.id: r.n_links for r in jaccard.ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sample = range(0, 300, 37)
    assert {i: got[i] for i in sample} == {i: sum(_jaccard(rows[i][1], t) >= 0.8 for j, t in rows if j != i) for i in sample}


def test_jaccard_join_of_repeated_rows_nulls_and_nothing(spark, docs, empty):
    assert jaccard.ngram_jaccard_join(empty).count() == 0
    again = docs.unionByName(docs).unionByName(spark.createDataFrame([(None, "a b c d e f", None, None, 1, 0.0, "")], SCHEMA))
    got = {r.id: r.n_links for r in jaccard.ngram_jaccard_join(again).collect()}
    assert got[1] == 2 and got[12] == 0 and None in got  # repeated rows count once
    assert jaccard.keep_one_of_each_class(again).count() == 2 * 12 + 1


def test_bands_reach_the_recall():
    bands, rows = jaccard.choose_bands(0.8, 0.9995)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9995 and bands * rows <= 100


def test_compact_windows_hold_every_run_once():
    rng = np.random.default_rng(3)
    for sizes in ((5,), (6, 30), (61, 3, 0, 17)):
        texts = [substring.mix(rng.integers(1, 20, n).astype(np.uint64)) for n in sizes]
        ends = np.cumsum([n + 1 for n in sizes]) - 1
        grams = np.concatenate([x for t in texts for x in (t, np.zeros(1, np.uint64))])
        at, left, right = substring.compact_windows(grams, ends, 5, 0)
        order = {g: k for k, g in enumerate(sorted(set(grams.tolist()), key=lambda g: int(_turned(g))))}
        for low, high in zip([0, *(ends[:-1] + 1)], ends, strict=True):
            for i in range(low, high):
                for j in range(i + 4, high):
                    holds = [k for k in range(len(at)) if left[k] <= i <= at[k] <= j <= right[k]]
                    assert len(holds) == 1 and order[grams[at[holds[0]]]] == min(order[g] for g in grams[i : j + 1].tolist())
        assert all(high < ends[np.searchsorted(ends, low)] for low, high in zip(left, right, strict=True))


def _turned(gram, turn=0):
    x = np.array([gram], dtype=np.uint64) * np.uint64(2 * turn + 0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9))[0]


def test_signatures_are_those_of_all_runs():
    rng = np.random.default_rng(4)
    texts = [substring.mix(rng.integers(1, 60, n).astype(np.uint64)) for n in (4, 70, 0, 12, 55)]
    key, owner = substring.signatures(texts, (5, 20))
    for k, t in enumerate(texts):
        want = set()
        for length in (5, 20):
            for i in range(len(t) - length + 1):
                sign = np.full(1, length, dtype=np.uint64)
                for turn in range(substring.TURNS):
                    sign = substring.mix(sign + min(t[i : i + length], key=lambda g, turn=turn: int(_turned(g, turn))))
                want.add(int(sign[0]))
        assert sorted(want) == sorted(key[owner == k].tolist())


def test_repeated_passages_are_found_and_cut(docs, texts):
    found = substring.repeated_passages(docs)
    rows = found.collect()
    assert {(r.doc, r.first_doc) for r in rows} >= {(2, 1), (3, 1), (11, 10)} and not {r.doc for r in rows} & {1, 4, 5, 6, 7, 9, 10, 12, 13, 15}
    span = next(r for r in rows if r.doc == 11)
    assert texts[11][span.start : span.end] == prose(2, 55)
    cut = {r.doc_id: r for r in substring.cut_passages(docs, found).collect()}
    assert set(cut) == set(texts) and cut[4].text is None and cut[2].text == "" and prose(2, 55) in cut[10].text and prose(2, 55) not in cut[11].text
    assert cut[12].text == texts[12] and cut[12].bin == "x"


def test_exact_passages_equal_brute_force(spark):
    rng = random.Random(9)
    blocks = [prose(100 + i, 52) for i in range(6)]
    texts = {i: " ".join([prose(200 + i, 30), *rng.sample(blocks, 2), prose(300 + i, 20)]) for i in range(25)}
    seen, want = {}, defaultdict(list)
    for d, t in texts.items():
        w = t.split()
        for i in range(len(w) - 49):
            if seen.setdefault(tuple(w[i : i + 50]), d) != d:
                want[d].append(set(range(i, i + 50)))
    got = defaultdict(set)
    for r in substring.repeated_passages(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect():
        got[r.doc] |= set(range(len(texts[r.doc][: r.start].split()), len(texts[r.doc][: r.end].split())))
    # A chance word beside a passage may be shared with another document than the first one that has the passage.
    assert set(got) == set(want) and all(len(w - got[d]) <= 3 for d in want for w in want[d]) and all(got[d] <= set().union(*want[d]) for d in got)


def test_passages_of_nothing(spark, empty):
    assert substring.repeated_passages(empty).count() == 0
    assert substring.cut_passages(empty, substring.repeated_passages(empty)).count() == 0


def test_ids_equal_the_library():
    from tokenizers import Tokenizer

    whole, own, rng = Tokenizer.from_file(PATH), encoder(PATH), random.Random(4)
    for _ in range(3000):
        t = "".join(rng.choice("ab 'é\n\t!1 .s漢 　<|") for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(own(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids
    assert np.frombuffer(own("a <|endoftext|>"), "<u4").tolist() == whole.encode("a <|endoftext|>", add_special_tokens=False).ids


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 32])
def test_packing_of_bits_is_exact(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000).astype("<u4")
    shard = tokenfile.Shard(tokenfile.write_shard([7, None], [400, 600], ids, bits, block_ids=97))
    assert (shard.read(0, 1000) == ids).all() and shard.doc_ids == [7, None] and shard.lengths.tolist() == [400, 600]
    assert all((shard.read(a, b) == ids[a:b]).all() for a, b in ((0, 1), (96, 98), (500, 777), (999, 1000), (5, 5)))
    assert len(tokenfile.pack(ids[:96], bits)) == 96 * bits // 8


def _ids(texts):
    return {i: [*np.frombuffer(encoder(PATH)(t), "<u4").tolist(), 0] for i, t in texts.items()}


def test_token_table_round_trip(docs, texts, empty):
    got, at = {r.id: r for r in tokenfile.read_token_table(tokenfile.write_token_table(docs, PATH)).collect()}, 0
    for i, ids in sorted(_ids(texts).items()):
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert tokenfile.read_token_table(tokenfile.write_token_table(empty, PATH)).count() == 0


def test_packed_pieces(docs, texts, empty):
    bins, pieces = defaultdict(list), defaultdict(list)
    for r in packing.pack_documents(docs.unionByName(docs.limit(0)), PATH).collect():
        bins[r.sequence_id].append((r.offset, r.length))
        pieces[r.id].append(r)
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    for i, ids in _ids(texts).items():
        at = 0
        for k, r in enumerate(sorted(pieces[i], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and (k == 0 or r.length == 2048) and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    assert packing.pack_documents(empty, PATH).count() == 0


def test_bounds_hold_and_are_met_by_small_optima():
    from itertools import combinations

    rng = random.Random(5)

    def best(items, capacity):
        if not items:
            return 0
        first, rest = items[0], items[1:]
        return 1 + min(best([x for k, x in enumerate(rest) if k not in c], capacity) for n in range(len(rest) + 1) for c in combinations(range(len(rest)), n) if first + sum(rest[k] for k in c) <= capacity)

    for _ in range(40):
        items = [rng.randint(1, 20) for _ in range(7)]
        lengths = np.array(items)
        bins, places, n = packing.best_fit_decreasing(lengths, 20)
        assert packing.bin_bound(np.bincount(lengths, minlength=21), 20) <= best(items, 20) <= n
        assert all(sum(lengths[bins == b]) <= 20 for b in range(n))


def test_partitions_exchange_documents(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    odd = docs.unionByName(docs.limit(20)).unionByName(docs.limit(5).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text"))
    monkeypatch.setattr(packing, "PIECES", 100)
    rows = packing.pack_documents(odd.repartition(7), PATH).collect()
    lengths = np.array([r.length for r in rows])
    least, used = packing.bin_bound(np.bincount(lengths, minlength=2049), 2048), len({r.sequence_id for r in rows})
    assert {r.gap for r in rows} == {used - least} and used <= least + 2 and len(rows) == len(set((r.sequence_id, r.offset) for r in rows))
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        edges = sorted(own)
        assert edges[0][0] == 0 and sum(n for _, n in own) <= 2048 and all(a + n == b for (a, n), (b, _) in zip(edges, edges[1:], strict=False))
    assert sum(r.id is None for r in rows) >= 5 and sum(r.piece == 0 for r in rows) == docs.count() + 25


def test_word_pieces_equal_greedy_matching(docs, texts, empty):
    first, later = wordpiece.pieces_of_byte_vocabulary(PATH)
    a, b = set(first), set(later)

    def greedy(word):
        n, i = 0, 0
        while i < len(word):
            j = next((j for j in range(len(word), i, -1) if word[i:j] in (b if i else a)), None)
            if j is None:
                return 1
            n, i = n + 1, j
        return n

    for r in wordpiece.count_tokens(docs, PATH).collect():
        found = re.findall(r"\w+|[^\w\s]", texts[r.doc_id] or "")
        assert (r.n_words, r.n_tokens, r.bin) == (len(found), sum(map(greedy, found)), "x")
    small = wordpiece.Automaton(["a", "ab", "abcd"], ["b", "c", "cd", "e"])
    assert [small.count(w) for w in ("abcd", "abcde", "abce", "abcc", "x", "abx")] == [1, 2, 3, 3, 1, 1]
    assert wordpiece.count_tokens(empty, PATH).count() == 0


def test_language_and_quality_on_odd_rows(spark, docs, empty):
    model = langid.fit_languages(langid.sample_languages(docs))
    got = {r.doc_id: r for r in langid.identify_languages(docs, model).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (4, 5, 6)) and all(0 <= r.score <= 1 and r.bin == "x" for r in got.values())
    assert got[9].lang_pred in ("en", "fr")
    assert langid.fit_languages(langid.sample_languages(empty)) is None and {r.lang_pred for r in langid.identify_languages(docs, None).collect()} == {"und"}
    labels = spark.createDataFrame([(i, i % 2 if i != 7 else None, 0) for i in range(1, 16)], "doc_id long, quality int, toxic int")
    scored = quality.classify_quality(docs, labels).collect()
    assert len(scored) == 15 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in scored)
    assert {r.score for r in quality.classify_quality(docs, labels.limit(0)).collect()} == {0.5} and quality.classify_quality(empty, labels).count() == 0


def test_scores_do_not_depend_on_partitions(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet") for n in ("documents", "labels"))
    lang, good = [], []
    for n in (1, 5):
        part = docs.repartition(n)
        named = langid.identify_languages(part.select("doc_id", "text"), langid.fit_languages(langid.sample_languages(part)))
        lang.append(sorted((r.doc_id, r.lang_pred, r.score) for r in named.collect()))
        good.append(sorted((r.doc_id, r.score) for r in quality.classify_quality(part.select("doc_id", "text"), labels.repartition(n)).collect()))
    assert good[0] == good[1] and [r[:2] for r in lang[0]] == [r[:2] for r in lang[1]]
    assert max(abs(a[2] - b[2]) for a, b in zip(*lang, strict=True)) < 1e-6  # products of float32, in other batches


def test_a_text_without_a_letter_has_no_language(spark):
    rows = spark.createDataFrame([(1, "½ ² ½"), (2, "123 !?"), (3, "à la mode"), (None, "x"), (5, None)], "doc_id long, text string")
    sample = spark.createDataFrame([("le la les un", "fr"), ("the of and", "en"), ("½ ½", "zz")], "text string, lang string")
    model = langid.fit_languages(sample)
    assert model[0] == ["en", "fr"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify_languages(rows, model).collect()}
    assert all(got[i] == ("und", 0.0) for i in (1, 2, 5)) and got[3][0] in ("en", "fr") and got[None][0] in ("en", "fr")


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    lang = {r.doc_id: r.lang for r in docs.collect()}
    named = langid.identify_languages(docs.select("doc_id", "text"), langid.fit_languages(langid.sample_languages(docs))).withColumn("held", quality.held_out()).where("held AND lang_pred <> 'und'").collect()
    told = [r for r in named if lang[r.doc_id] is not None]
    assert len(told) > 150 and sum(r.lang_pred == lang[r.doc_id] for r in told) >= 0.96 * len(told)
    good = {r.doc_id: r.quality for r in labels.where("quality IS NOT NULL").collect()}
    scored = [r for r in quality.classify_quality(docs.select("doc_id", "text"), labels).withColumn("held", quality.held_out()).where("held").collect() if r.doc_id in good]
    assert len(scored) > 80 and sum(r.predicted == good[r.doc_id] for r in scored) >= 0.95 * len(scored)


def test_null_ids_repeated_rows_and_clashing_columns(spark):
    schema = "doc_id long, text string, lang string, source string, topic string, lang_pred string, score string, predicted string, tokens string, probability string, sampled string, n_tokens string, id string, piece string"
    filled = ("x",) * 9
    rows = [(i, prose(600 + i, 40), "en" if i % 2 else "fr", "s", "t", *filled) for i in range(30)] + [(None, prose(1, 30), "en", None, None, *filled)] * 3 + [(5, prose(605, 40), None, "s", "t", *filled)] * 2
    df = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(i, i % 2, 0, "x") for i in range(30)] + [(None, 1, 0, "x")], "doc_id long, quality int, toxic int, text string")
    n = len(rows)
    named = langid.identify_languages(df, langid.fit_languages(langid.sample_languages(df)))
    assert named.count() == n and named.columns[-2:] == ["lang_pred", "score"] and {r.lang_pred for r in named.collect()} <= {"en", "fr"}
    scored = quality.classify_quality(df, labels)
    assert scored.count() == n and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in scored.collect())
    counted = wordpiece.count_tokens(df, PATH).collect()
    assert len(counted) == n and all(isinstance(r.n_tokens, int) for r in counted)
    mixed = mixing.mix_sources(df)
    assert mixed.count() == n and all(0 <= r.probability <= 1 and r.topic in ("t", None) for r in mixed.collect())
    packed = packing.pack_documents(df, PATH).collect()
    assert sum(r.piece == 0 for r in packed) == n and sum(r.id is None for r in packed) == 3 and len({(r.sequence_id, r.offset) for r in packed}) == len(packed)
    read = tokenfile.read_token_table(tokenfile.write_token_table(df, PATH)).collect()
    assert len(read) == n and sum(r.id is None for r in read) == 3 and sorted(r.start for r in read) == [0, *np.cumsum([r.n_tokens for r in sorted(read, key=lambda r: r.start)])[:-1].tolist()]
    found = substring.repeated_passages(df)
    assert found.count() == 0 and jaccard.ngram_jaccard_join(df).where("id = 5").first().n_links == 0


def test_very_long_texts(spark):
    common = prose(77, 3000)
    texts = {1: " ".join([prose(78, 40_000), common]), 2: " ".join([common, prose(79, 40_000)]), 3: "of " * 60_000, 4: "of " * 50_000}
    rows = substring.repeated_passages(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert max(r.n_words for r in rows if (r.doc, r.first_doc) == (2, 1)) >= 3000 and any((r.doc, r.first_doc) == (4, 3) for r in rows)


def test_tokens_in_several_shards(docs, texts, monkeypatch):
    monkeypatch.setattr(tokenfile, "SHARD_IDS", 500)
    written = tokenfile.write_token_table(docs, PATH)
    assert written.count() > 5
    got, at = {r.id: r for r in tokenfile.read_token_table(written).collect()}, 0
    for i, ids in sorted(_ids(texts).items()):
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_models_learn_from_data(spark):
    junk = lambda i: " ".join(w.upper() + "!!" for w in prose(i, 40).split())
    rows = [(i, junk(i) if i % 3 == 0 else prose(i, 40) + ".", "x" if i % 2 else "y") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0), 0) for i in range(400)], "doc_id long, quality int, toxic int")
    wrong = [r.doc_id for r in quality.classify_quality(df, labels).withColumn("held", quality.held_out()).where("held").collect() if r.predicted != int(r.doc_id % 3 != 0)]
    assert len(wrong) <= 2


def test_mixing_meets_its_targets(spark, docs, empty):
    rows = [(i, "w " * (20 + i % 7 * 300), "en" if i % 4 else None, f"s{i % 3 if i % 2 else 0}", 0, 0.0, "") for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    mixed = mixing.mix_sources(df, keep=0.5)
    cells = mixed.groupBy("source", "lang", "topic").agg({"tokens": "sum", "probability": "max"}).toPandas()
    assert abs((cells["sum(tokens)"] * cells["max(probability)"]).sum() / cells["sum(tokens)"].sum() - 0.5) < 1e-6
    assert mixed.columns[: len(df.columns)] == df.columns and mixed.count() == 600
    odd = {r.doc_id: r for r in mixing.mix_sources(docs).collect()}
    assert len(odd) == 15 and odd[4].tokens == 0 and odd[4].probability <= 1
    assert mixing.mix_sources(empty).count() == 0 and mixing.plan_mix(empty).figures() == {"kept": 0.0, "residual": 0.0, "off": 0.0}


def _cells(plan):
    return plan.cells.where("tokens > 0").toPandas()


def _feasible(there, share, total):
    """Water-filling by bisection: shares of ``total``, none more than is there."""
    low, high = 0.0, 1e12
    for _ in range(300):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(there[v], mid * share[v]) for v in there) < total else (low, mid)
    return {v: min(there[v], high * share[v]) for v in there}


def _check_optimum(cells, aims):
    """Marginals as they should be; the logarithms of the probabilities under 1 are sums of a part for each value, and those at 1 are where that sum is 0 or more."""
    for d, aim in aims.items():
        got = (cells.tokens * cells.probability).groupby(cells[d]).sum().to_dict()
        assert all(got[v] == pytest.approx(aim[v], rel=1e-6) for v in aim)
    free = cells[(cells.probability > 0) & (cells.probability < 1 - 1e-9)]
    names = [(d, v) for d in aims for v in sorted(cells[d].unique())]
    table = lambda rows: np.array([[float(r[d] == v) for d, v in names] for _, r in rows.iterrows()])
    parts, *_ = np.linalg.lstsq(table(free), np.log(free.probability.to_numpy()), rcond=None)
    assert np.allclose(table(free) @ parts, np.log(free.probability), atol=1e-5)


def test_mixing_finds_the_optimum_with_full_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("source IS NOT NULL")
    plan = mixing.plan_mix(docs)
    cells, aims = _cells(plan), {}
    total = mixing.KEEP * cells.tokens.sum()
    for d, power in mixing.POWERS.items():
        there = cells.tokens.groupby(cells[d]).sum().astype(float).to_dict()
        raised = {v: x**power for v, x in there.items()}
        aims[d] = _feasible(there, {v: x / sum(raised.values()) for v, x in raised.items()}, total)
    assert aims["topic"]["note"] == pytest.approx(cells.tokens[cells.topic == "note"].sum()) and plan.converged  # fewer than its target asks for: all are taken
    _check_optimum(cells, aims)
    figures = plan.figures()
    assert figures["kept"] == pytest.approx(mixing.KEEP) and figures["off"] < 1e-8 and 0.01 < figures["residual"] < 0.1
    report = {(r.dim, r.value): r for r in plan.report().collect()}
    assert report["topic", "note"].expected == pytest.approx(aims["topic"]["note"] / total) and report["topic", "note"].wanted > 0.09


def test_mixing_can_hold_the_shares_instead(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("source IS NOT NULL")
    plan = mixing.plan_mix(docs, hold="shares")
    figures, cells = plan.figures(), _cells(plan)
    note = {r.value: r for r in plan.report().where("dim = 'topic'").collect()}["note"]
    assert figures["residual"] < 1e-8 and note.expected == pytest.approx(note.wanted) and 0.1 < figures["kept"] < 0.4
    assert figures["kept"] * cells.tokens.sum() * note.wanted == pytest.approx(note.tokens)  # as many tokens as that leaves room for


def test_given_targets_feasible_or_not(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("source IS NOT NULL")
    names = sorted(r.source for r in docs.select("source").distinct().collect())
    wanted = spark.createDataFrame([(names[0], 2.0), (names[1], 6.0), ("no such source", 0.0)], "source string, share double")
    plan = mixing.plan_mix(docs, keep=0.05, targets={"source": wanted})
    given = mixing.mix_sources(docs, mix=plan).toPandas()
    got = (given.tokens * given.probability).groupby(given.source).sum()
    assert got[names[0]] / got.sum() == pytest.approx(0.25, abs=1e-6) and got[names[1]] / got.sum() == pytest.approx(0.75, abs=1e-6)
    assert not given[~given.source.isin(names[:2])].sampled.any() and given.probability.max() <= 1
    nothing = spark.createDataFrame([(names[0], 1.0), ("no such source", 1.0)], "source string, share double")
    figures = mixing.plan_mix(docs, targets={"source": nothing}).figures()
    assert figures["residual"] == pytest.approx(0.5) and figures["kept"] == pytest.approx(mixing.KEEP)


def test_targets_that_contradict_each_other_are_reported(spark):
    """All of one source is in one language: the shares can't both hold, and passes end where neither does."""
    rows = [(i, "w " * 50, "en" if i % 2 else "fr", "a" if i % 2 else "b") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    share = lambda d, *pairs: spark.createDataFrame(pairs, f"{d} string, share double")
    plan = mixing.plan_mix(docs, keep=0.4, targets={"source": share("source", ("a", 0.7), ("b", 0.3)), "lang": share("lang", ("en", 0.3), ("fr", 0.7))}, rounds=20)
    assert plan.rounds <= 20 and plan.figures()["off"] > 0.1 and plan.cells.where("probability > 1 OR probability < 0").count() == 0


def test_raking_beyond_one_task_gives_the_same(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    at = lambda: {(r.source, r.lang, r.topic): r.probability for r in mixing.plan_mix(docs).cells.collect()}
    one = at()
    monkeypatch.setattr(mixing, "SMALL", 3)
    assert at() == pytest.approx(one)


def _edited(words_, kind, n, at):
    put = prose(900 + n, n).split()
    return [*words_[:at], *put, *words_[at + n * (kind == "replace") :]] if kind != "delete" else [*words_[:at], *words_[at + n :]]


@pytest.mark.parametrize("kind", ["insert", "delete", "replace"])
def test_edited_passages_equal_brute_force(kind):
    grams = lambda t: substring.shingles(words(t)[0])
    for n in range(1, 13):
        for size, at in ((90, 45), (95, 47), (140, 40), (300, 150)):
            passage = prose(40 + n, size).split()
            copy = _edited(passage, kind, n, at)
            one = " ".join([prose(50 + n, 70), *passage, prose(60 + n, 40)])
            two = " ".join([prose(70 + n, 30), *copy, prose(80 + n, 80)])
            for earlier, later in ((one, two), (two, one)):
                x, y = grams(later), grams(earlier)
                shared = np.flatnonzero(np.isin(x, y))
                a, b = int(shared[0]), int(shared[-1])
                c, d = np.flatnonzero(np.isin(y, x))[[0, -1]].tolist()
                s, t = set(x[a : b + 1].tolist()), set(y[c : d + 1].tolist())
                got = substring.passages(x, y, 46, 0.8)
                if len(s & t) / len(s | t) >= 0.8:
                    assert [g[:4] for g in got] == [(a, b, c, d)] and got[0][4] == pytest.approx(len(s & t) / len(s | t)), (n, size)
                else:
                    assert all(g[4] >= 0.8 and g[1] - g[0] >= 45 for g in got), (n, size)


def test_an_earlier_document_without_the_passage_hides_nothing(spark):
    texts, pairs = {}, set()
    for k in range(40):  # the first of three has a line of the passage or a far variant of it, the others the passage
        passage = prose(2000 + k, 54).split()
        other = list(passage)
        if k % 2:
            other = [*prose(2100 + k, 30).split(), *passage[12:34], *prose(2200 + k, 30).split()]
        else:
            other[27] = other[9] = "changed"
        for j, w in enumerate((other, passage, passage)):
            texts[10 * k + j] = " ".join([prose(2300 + 10 * k + j, 20), *w, prose(2800 + 10 * k + j, 20)])
        pairs.add((10 * k + 2, 10 * k + 1))
    rows = substring.repeated_passages(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {(r.doc, r.first_doc) for r in rows} == pairs


def test_a_line_of_many_documents_hides_no_passage(spark):
    line, passage = prose(31, 20), prose(32, 40)
    texts = {i: " ".join([prose(3000 + i, 40), line, prose(3200 + i, 40)]) for i in range(60)}
    texts |= {i: " ".join([prose(3400 + i, 10), line, passage, prose(3500 + i, 10)]) for i in range(60, 66)}
    rows = substring.repeated_passages(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc for r in rows} == set(range(61, 66)) and {r.doc for r in rows if r.first_doc == 60} == set(range(61, 66))


def _near_passages(n):
    for k in range(n):
        passage = prose(5000 + k, 50).split()
        copy = list(passage)
        copy[4 + k % 42] = "changed"  # 41 of 51 shingles stay, 0.804
        yield " ".join([prose(6000 + k, k % 30), *passage, prose(7000 + k, 30)]), " ".join([prose(8000 + k, 40), *copy, prose(9000 + k, k % 20)])


def test_every_near_passage_has_a_seed():
    seed = substring.seed_grams(46, 0.8)
    assert seed == 19 and substring.seed_grams(46, 1.0) == 46
    for one, two in _near_passages(300):
        x, y = (substring.shingles(words(t)[0]) for t in (one, two))
        if substring.passages(y, x, 46, 0.8):
            key, owner = substring.signatures([x, y], (seed,))
            assert np.isin(key[owner == 0], key[owner == 1]).any()


def test_passages_do_not_depend_on_partitions_or_batches(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    results = []
    for n in (1, 3, 16):
        monkeypatch.setattr(substring, "BATCH", 1000 * n)
        results.append(sorted(map(tuple, substring.repeated_passages(docs.repartition(n)).collect())))
    assert results[0] and results[0] == results[1] == results[2]


def test_common_signatures_are_dealt_into_parts(spark, monkeypatch):
    passage = prose(33, 60)
    texts = {i: " ".join([prose(4000 + i, 20), *([passage] if i % 2 else []), prose(4200 + i, 20)]) for i in range(100)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    monkeypatch.setattr(substring, "COMMON", 1.0)
    plain = substring.repeated_passages(docs).collect()
    monkeypatch.setattr(substring, "COMMON", 0.005)
    monkeypatch.setattr(substring, "PARTS", 5)
    assert len(substring.common_signatures(docs.selectExpr("doc_id AS doc", "text"), (19, 46))) > 0
    dealt = substring.repeated_passages(docs).collect()
    assert {r.doc for r in plain} == {r.doc for r in dealt} == set(range(3, 100, 2))
    assert sum(r.first_doc == 1 for r in plain) == 49 > sum(r.first_doc == 1 for r in dealt) and len(dealt) < 2 * len(plain)


def _covered(rows):
    out = defaultdict(set)
    for doc, start, end in rows:
        out[doc] |= set(range(start, end))
    return out


def test_recall_on_the_tables_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: words(r.text) for r in docs.collect()}
    grams = {d: substring.shingles(w[0]) for d, w in texts.items()}
    by_key = defaultdict(list)
    for d, g in sorted(grams.items()):
        for k in substring.signatures([g], (19,))[0].tolist():  # what every passage has
            by_key[k].append(d)
    pairs = {(x, y) for ds in by_key.values() for i, x in enumerate(ds) for y in ds[:i]}
    want = []
    for x, y in pairs:
        for a, b, *_ in substring.passages(grams[x], grams[y], 46, 0.8):
            want.append((x, int(texts[x][1][a]), int(texts[x][2][min(b + 5, len(texts[x][2])) - 1])))
    want, got = _covered(want), _covered((r.doc, r.start, r.end) for r in substring.repeated_passages(docs).collect())
    assert all(got[d] <= want[d] for d in got)
    assert sum(len(got[d]) for d in want) >= 0.98 * sum(map(len, want.values())) and len(set(want) - set(got)) <= 0.02 * len(want)


def test_near_passages_equal_brute_force(spark):
    texts = dict(enumerate(t for pair in _near_passages(1000) for t in pair))
    want, grams = set(), {i: substring.shingles(words(t)[0]) for i, t in texts.items()}
    for i in range(1, 2000, 2):
        p, q = (np.flatnonzero(np.isin(grams[a], grams[b])) for a, b in ((i, i - 1), (i - 1, i)))
        s, t = (set(g[r[0] : r[-1] + 1].tolist()) for g, r in ((grams[i], p), (grams[i - 1], q)))
        if len(p) and len(s & t) / len(s | t) >= 0.8 and p[-1] - p[0] >= 45:
            want.add((i, i - 1))
    rows = substring.repeated_passages(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert len(want) > 900 and len(want - {(r.doc, r.first_doc) for r in rows}) <= 1


def test_large_components_are_compared_by_bucket(spark, monkeypatch):
    texts = {}
    for k in range(6):  # chains of copies, each further from the first
        w = prose(700 + k, 90).split()
        for j in range(12):
            w = [*w]
            w[(7 * j) % 90] = f"changed{k}x{j}"
            texts[20 * k + j] = " ".join(w)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    run = lambda: sorted(map(tuple, jaccard.ngram_jaccard_join(docs).collect()))
    plain = run()
    links = {i: sum(_jaccard(texts[i], texts[j]) >= 0.8 for j in texts if j != i) for i in texts}
    assert {r[0]: r[2] for r in plain} == links and sum(links.values()) > 100
    for block in (4, 1):  # at 1 whole chains cost more than their buckets
        monkeypatch.setattr(jaccard, "BLOCK", block)
        assert run() == plain


def test_hot_document_ids_cost_the_language_sample_nothing(spark):
    rows = [(7, f"the same words again {i % 3}", "en") for i in range(3000)] + [(i, f"mots {i}", "fr") for i in range(100, 140)]
    sample = langid.sample_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"), limit=1000)
    assert sample.count() == sum(not zlib.crc32(str(i).encode()) % 4 == 2 for i in range(100, 140)) + 3 * (zlib.crc32(b"7") % 4 != 2)


def test_jaccard_join_of_two_texts_under_one_id(spark):
    rows = []
    for k in range(12):  # the first of three ids has two texts, each of which links to one of the others
        for j in (1, 2):
            base = prose(400 + 10 * k + j, 100).split()
            near = [*base[:50], "changed", *base[51:]]
            rows += [(10 * k, " ".join(base)), (10 * k + j, " ".join(near))]
    got = {r.id: (r.n_links, r.class_id) for r in jaccard.ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {10 * k + j: (2 if j == 0 else 1, 10 * k) for k in range(12) for j in range(3)}
