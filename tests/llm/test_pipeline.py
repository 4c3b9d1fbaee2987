"""Each stage of the pipeline on its own input, against brute force on the smallest tables."""

import re
import zlib

import pytest

pytest.importorskip("tidewell.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from tidewell.llm import mixing, quality, substring, words  # noqa: E402
from tidewell.llm.bpe import encoder  # noqa: E402

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    root, docs = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(root / str(k)))
        docs = spark.read.parquet(str(root / str(k)))
        out.append(docs)
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def grams(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_stages_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "near duplicates", "substring dedup", "mixing sources", "best-fit packing"]
    assert all(s.columns == COLUMNS for s in stages[:5])


def test_quality_keeps_what_scores_enough(spark, stages):
    scored = quality.classify_quality(stages[0], spark.read.parquet(f"{SF}/labels.parquet")).collect()
    assert set(rows(stages[1])) == {r.doc_id for r in scored if r.score >= 0.7}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [d for d, q in labels.items() if q == 1]
    assert sum(d in rows(stages[1]) for d in clean) >= 0.97 * len(clean)


def test_one_of_each_class_stays(stages):
    before, after = rows(stages[1]), rows(stages[2])
    sets, component = {d: grams(r.text) for d, r in before.items()}, {d: d for d in before}
    ids = sorted(before)
    near = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    for _ in ids:
        for a, b in near:
            component[a] = component[b] = min(component[a], component[b])
    assert set(after) == {d for d in ids if component[d] == d}
    assert all(after[d] == before[d] for d in after)


def test_repeated_passages_go_and_the_first_stays(stages):
    before, after = rows(stages[2]), rows(stages[3])
    assert set(before) == set(after) and all(r.n_chars == len(r.text) for r in after.values())
    seen, exact = {}, set()
    for d in sorted(before):
        w = re.findall(r"[^\W_]+", before[d].text.lower())
        for i in range(len(w) - 49):
            if seen.setdefault(tuple(w[i : i + 50]), d) != d:
                exact.add(d)
    assert exact and all(len(after[d].text) < len(before[d].text) for d in exact)
    grams = {d: substring.shingles(words.words(r.text)[0]) for d, r in before.items()}
    near = {d for d in before for e in before if e < d and substring.passages(grams[d], grams[e], 46, 0.8)}  # every pair
    cut = {d for d in before if before[d].text != after[d].text}
    assert exact <= cut <= near and len(near - cut) <= 0.02 * len(near)


def test_sampling_follows_the_probabilities(stages):
    mixed = mixing.mix_sources(stages[3]).collect()
    assert set(rows(stages[4])) == {r.doc_id for r in mixed if r.sampled}
    expected = sum(r.probability * r.tokens for r in mixed)
    assert expected == pytest.approx(mixing.KEEP * sum(r.tokens for r in mixed), rel=0.02)


def test_packing_holds_every_token(stages):
    encode, texts = encoder(corpus_pipeline.tokenizer_path()), rows(stages[4])
    got: dict = {}
    for r in sorted(stages[5].collect(), key=lambda r: (r.doc_id, r.piece)):
        got.setdefault(r.doc_id, []).append(r)
    assert set(got) == set(texts)
    for d, pieces in got.items():
        ids = encode(texts[d].text) + bytes(4)
        assert [zlib.crc32(ids[4 * r.start : 4 * (r.start + r.length)]) for r in pieces] == [r.ids_crc32 for r in pieces] and sum(4 * r.length for r in pieces) == len(ids)
    used = stages[5].groupBy("sequence_id").sum("length").collect()
    assert max(r["sum(length)"] for r in used) <= 2048


def test_the_whole_run_is_its_stages(spark, stages):
    of = lambda df: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert of(corpus_pipeline.run(spark, SF)) == of(stages[5])


def test_an_empty_table_passes_through(spark):
    none = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0
