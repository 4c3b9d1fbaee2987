"""Answers of text models: JSON objects, maybe inside prose, with required keys."""

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import once

# The keys that an answer must have.
TRIAGE_KEYS = ("headline", "relevance_score", "content_type")
EXTRACTION_KEYS = ("headline", "summary", "relevance_score", "brands_mentioned", "vehicles_mentioned", "features_extracted", "competitive_signal", "content_type")
NARRATIVE_KEYS = ("title", "summary", "implications_for_western_oems", "competitive_impact_score")


def _parsed(text: Column) -> Column:
    """The text and its value (a variant, null if it is no JSON)."""
    return F.struct(text.alias("text"), F.try_parse_json(text).alias("value"))


def _salvaged(text: Column) -> Column:
    """The text if it is JSON, else its part from the first opening to the last closing brace if that is, with its value: parsed once, or twice in prose."""

    def inner(whole: Column) -> Column:
        low = F.locate("{", text)
        high = F.length(text) - F.locate("}", F.reverse(text)) + 1
        part = F.when((low > 0) & F.contains(text, F.lit("}")) & (high > low), F.substring(text, low, high - low + 1))
        return F.when(whole["value"].isNotNull(), whole).otherwise(once(_parsed(part), lambda p: F.when(p["value"].isNotNull(), p)))

    return once(_parsed(text), inner)


def _object(text: Column, valid: Callable[[Column], Column] | None = None) -> Column:
    """The text of the object in it, or null; ``valid`` is asked of its value."""

    def check(found: Column) -> Column:
        ok = F.startswith(F.schema_of_variant(found["value"]), F.lit("OBJECT"))
        return F.when(ok if valid is None else ok & valid(found["value"]), found["text"])

    return once(_salvaged(text), check)


def _has(value: Column, keys: Sequence[str]) -> Column:
    """Does an object have all these keys? A key may hold null."""
    return reduce(lambda x, y: x & y, (F.try_variant_get(value, f"$.{k}", "variant").isNotNull() for k in keys))


def _whole(value: Column, key: str) -> Column:
    return once(F.try_variant_get(value, f"$.{key}", "variant"), lambda v: F.when(F.schema_of_variant(v).isin("BIGINT", "INT"), F.try_variant_get(v, "$", "bigint")))


def salvage_json(text: Column) -> Column:
    """The text if it is JSON; else its part from the first opening to the last closing brace if that is; else null."""
    return _salvaged(text)["text"]


def json_object(text: Column) -> Column:
    """As ``salvage_json``, for objects only: any other JSON value is null, without another try."""
    return _object(text)


def has_keys(json: Column, keys: Sequence[str]) -> Column:
    """Is it an object with all these keys? A key may hold null."""
    return F.coalesce(F.size(F.array_except(F.array(*(F.lit(k) for k in keys)), F.json_object_keys(json))) == 0, F.lit(False))


def whole_number(json: Column, key: str) -> Column:
    """The value under a key if it is an integer (not a string, fraction, boolean or null)."""
    return _whole(F.try_parse_json(json), key)


def valid_extraction(text: Column) -> Column:
    """The answer's object, or null."""
    return _object(text, lambda v: _has(v, EXTRACTION_KEYS))


def valid_narrative(text: Column) -> Column:
    return _object(text, lambda v: _has(v, NARRATIVE_KEYS))


def valid_triage(text: Column) -> Column:
    return _object(text, lambda v: _has(v, TRIAGE_KEYS) & _whole(v, "relevance_score").isNotNull())


def valid_resolution(text: Column) -> Column:
    """An object that names a brand."""
    return _object(text, lambda v: F.coalesce(F.try_variant_get(v, "$.name_en", "string"), F.lit("")) != "")
