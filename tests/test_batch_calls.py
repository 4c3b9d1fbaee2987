"""Requests that are answered in batches: deaths between any two steps, retries, expiry, late answers."""

import json
from collections import Counter
from datetime import datetime, timedelta

import pytest

from tidewell.operators import runs
from tidewell.sources import batch_calls, snapshots

NOW = datetime(2026, 7, 10, 12)


def _calls(spark, tmp_path, fails=(), silent=(), **more):
    """A service that keeps a file for each batch; ids in ``fails`` fail, those in ``silent`` are never answered."""
    box = tmp_path / "box"
    box.mkdir()

    def submit(batch_id, ids, prompts):
        with open(box / "log", "a") as log:
            log.write(json.dumps([batch_id, ids]) + "\n")
        (box / f"{batch_id}.json").write_text(json.dumps(list(zip(ids, prompts, strict=True))))

    def poll(batch_id):
        rows = json.loads((box / f"{batch_id}.json").read_text())
        return [(i, i not in fails, f"re {p}") for i, p in rows if i not in silent for _ in range(2)]  # every result comes twice

    store = snapshots.RunStore(spark, f"file://{tmp_path}/store")
    return batch_calls.BatchCalls(store, batch_calls.CallService(submit, poll), **{"size": 3, "retries": 1, "max_age": 3600, "buckets": 2} | more), box


def _prompts(spark, *rows):
    return spark.createDataFrame(list(rows), "request_id string, prompt string")


def _rows(calls):
    return {r.request_id: r for r in calls.requests().collect()}


def test_every_request_ends_once_and_batches_are_bounded(spark, tmp_path):
    calls, box = _calls(spark, tmp_path, fails=("r1",), silent=("r2",))
    calls.enqueue("first", _prompts(spark, *((f"r{i}", f"p{i}") for i in range(8)), ("r3", "p30"), (None, "p"), ("none", None), ("empty", "")), NOW)
    for hour in range(0, 8, 2):
        calls.tick(f"t{hour}", NOW + timedelta(hours=hour))
    rows = _rows(calls)
    assert Counter(r.state for r in rows.values()) == {"succeeded": 7, "errored": 1, "expired": 1, "canceled": 1}
    assert rows["r1"].state == "errored" and rows["r2"].state == "expired" and rows["none"].state == "canceled"
    assert rows["r3"].answer == "re p3" and rows["empty"].answer == "re " and rows["r1"].answer is None
    assert rows["r0"].attempts == 1 and rows["r1"].attempts == rows["r2"].attempts == 2
    sent = [json.loads(line) for line in (box / "log").read_text().splitlines()]
    assert all(len(ids) <= 3 for _, ids in sent)
    assert Counter(i for _, ids in sent for i in ids) == {f"r{i}": 2 if i in (1, 2) else 1 for i in range(8)} | {"empty": 1}
    assert {r.batch_id: r.total for r in runs.batch_progress(calls.requests().where("state = 'succeeded'")).collect()} == Counter(r.batch_id for r in rows.values() if r.state == "succeeded")


@pytest.mark.parametrize("dies", range(6))
def test_a_tick_that_dies_goes_on_under_its_name(spark, tmp_path, monkeypatch, dies):
    calls, box = _calls(spark, tmp_path)
    calls.enqueue("first", _prompts(spark, *((f"r{i}", f"p{i}") for i in range(4))), NOW)
    commit, met = calls.store.commit, []

    def late(base, run, tables):
        met.append(run)
        if len(met) == dies + 1:
            raise OSError("the driver is gone")
        return commit(base, run, tables)

    monkeypatch.setattr(calls.store, "commit", late)
    for name, hour in (("a", 0), ("b", 2)):
        try:
            calls.tick(name, NOW + timedelta(hours=hour))
        except OSError:
            calls.tick(name, NOW + timedelta(hours=hour))
    assert len(met) == 7  # six steps and the one that died
    assert {i: (r.state, r.answer, r.attempts) for i, r in _rows(calls).items()} == {f"r{i}": ("succeeded", f"re p{i}", 1) for i in range(4)}
    batches = {}
    for batch, ids in map(json.loads, (box / "log").read_text().splitlines()):
        assert batches.setdefault(batch, ids) == ids  # what is sent again is the same batch
    assert sorted(i for ids in batches.values() for i in ids) == [f"r{i}" for i in range(4)]


def test_pauses_double_and_known_requests_stay(spark, tmp_path):
    calls, _ = _calls(spark, tmp_path, fails=("r0",), retries=3)
    calls.enqueue("first", _prompts(spark, ("r0", "p")), NOW)
    calls.tick("a", NOW)
    calls.tick("b", NOW + timedelta(minutes=10))
    assert _rows(calls)["r0"].due == NOW + timedelta(minutes=11)
    calls.tick("c", NOW + timedelta(minutes=10, seconds=30))  # not due yet
    assert _rows(calls)["r0"].state == "waiting"
    calls.tick("d", NOW + timedelta(minutes=11))
    calls.tick("e", NOW + timedelta(minutes=20))
    assert _rows(calls)["r0"].due == NOW + timedelta(minutes=22)
    calls.enqueue("again", _prompts(spark, ("r0", "other")), NOW)
    assert _rows(calls)["r0"].prompt == "p" and _rows(calls)["r0"].attempts == 2


def test_nothing_to_do(spark, tmp_path):
    calls, box = _calls(spark, tmp_path)
    calls.enqueue("first", _prompts(spark), NOW)
    calls.tick("a", NOW)
    assert not _rows(calls) and not (box / "log").exists()


def test_a_folder_holds_each_batch_once_in_few_files(spark, tmp_path):
    answers = _prompts(spark, ("r1", "p")).selectExpr("request_id", "true AS ok", "'re' AS answer")
    service = batch_calls.FolderService(f"file://{tmp_path}/outbox", answers)
    rows = spark.range(400, numPartitions=4).selectExpr("concat('r', id) AS request_id", "concat('p', id) AS prompt", "concat('b', id % 50) AS batch_id")
    for part in (rows.where("batch_id < 'b3'"), rows, rows):  # some were sent before a run died, all are sent again
        service.submit(part)
    sent = spark.read.parquet(f"file://{tmp_path}/outbox")
    assert sorted(r.request_id for r in sent.collect()) == sorted(f"r{i}" for i in range(400))
    assert len(list((tmp_path / "outbox").rglob("*.parquet"))) < 25
    assert [tuple(r) for r in service.results(rows.select("batch_id").distinct()).collect()] == [("b1", "r1", True, "re")]


def test_texts_are_written_once(spark, tmp_path):
    calls, _ = _calls(spark, tmp_path)
    calls.enqueue("first", _prompts(spark, ("r0", "p"), ("r1", "p")), NOW)
    calls.tick("a", NOW)
    calls.tick("b", NOW + timedelta(hours=2))
    written = lambda name: [p.name for p in (tmp_path / "store" / "data" / name).iterdir()]
    assert len(written("prompts")) == len(written("answers")) == 1 < len(written("requests"))
