"""Text models: a callable from prompts to answers, run in batches inside tasks. The default one is offline and deterministic."""

import json
import time
import zlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

TextModel = Callable[[Sequence[str]], Sequence[str | None]]
BATCH, RETRIES = 100, 3


def offline_model(prompts: Sequence[str]) -> list[str | None]:
    """An answer with every key that any step asks for, made from the prompt's checksum, in a little prose."""
    out: list[str | None] = []
    for p in prompts:
        n = zlib.crc32(p.encode("utf-8", "replace"))
        answer = {
            "headline": p[:60], "summary": p[:200], "relevance_score": 1 + n % 10, "content_type": ("news", "review", "opinion")[n % 3], "brands_mentioned": [], "vehicles_mentioned": [], "features_extracted": [],
            "competitive_signal": None, "title": p[:60], "implications_for_western_oems": "", "competitive_impact_score": 1 + n % 5, "name_en": "",
        }
        out.append(f"Here it is: {json.dumps(answer)}")
    return out


def with_retries(model: TextModel, prompts: Sequence[str], retries: int = RETRIES, pause: float = 1.0) -> list[str | None]:
    """Answers, or nulls if the first call and all retries fail; each pause is twice the last."""
    for turn in range(retries + 1):
        try:
            return list(model(prompts))
        except Exception:
            if turn < retries:
                time.sleep(pause * 2**turn)
    return [None] * len(prompts)


def ask(rows: DataFrame, model: TextModel = offline_model, prompt_col: str = "prompt", answer_col: str = "answer", batch: int = BATCH, pause: float = 1.0) -> DataFrame:
    """``rows`` with an answer to each prompt; a null prompt has a null answer and isn't sent."""
    names, at = list(rows.columns), rows.columns.index(prompt_col)
    schema = T.StructType([*rows.schema.fields, T.StructField(answer_col, T.StringType())])

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for low in range(0, part.num_rows, batch):
                piece = part.slice(low, batch)
                prompts = piece.column(at).to_pylist()
                sent = [p for p in prompts if p is not None]
                answers = iter(with_retries(model, sent, pause=pause) if sent else [])
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array([None if p is None else next(answers) for p in prompts], pa.string())], [*names, answer_col])

    return rows.mapInArrow(call, schema)
