"""Strings: blanks, trimming, keywords, and the matching-blocks ratio of two titles."""

from collections.abc import Callable, Sequence
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), 0)


def non_blank(text: Column) -> Column:
    """Null for an empty string."""
    return F.nullif(text, F.lit(""))


def strip(text: Column) -> Column:
    """Without any white space at the ends, the ideographic space included."""
    return F.regexp_replace(text, r"^[\s　 ]+|[\s　 ]+$", "")


def keywords_in(text: Column, keywords: Sequence[str]) -> Column:
    """Those keywords that the lower-cased text holds anywhere, in their own order; none for a null."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.filter(F.array(*(F.lit(k) for k in keywords)), lambda k: F.contains(low, k))


def any_keyword(text: Column, keywords: Sequence[str]) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.exists(F.array(*(F.lit(k) for k in keywords)), lambda k: F.contains(low, k))


def _ratio(a: pa.Array, b: pa.Array, least: pa.Array) -> pa.Array:
    """Lower-cased matching-blocks ratio, or 0 where a quick upper bound of it is under ``least``; the second title's index is built once for a run of equal ones."""
    matcher, out, last = SequenceMatcher(), [], None
    for x, y, need in zip(a.to_pylist(), b.to_pylist(), least.to_pylist(), strict=True):
        if not x or not y:
            out.append(0.0)
            continue
        x, z = x.lower(), y.lower()
        if x == z:
            out.append(1.0)
            continue
        if y != last:
            matcher.set_seq2(z)
            last = y
        matcher.set_seq1(x)
        hopeless = need > 0 and (matcher.real_quick_ratio() < need or matcher.quick_ratio() < need)
        out.append(0.0 if hopeless else matcher.ratio())
    return pa.array(out, pa.float64())


def letters(title: Column) -> Column:
    """How often each character of the lower-cased title occurs, as a map; null for a null title and for scripts in which lower case could differ between the JVM and Python."""
    plain = title.rlike(r"^[\x00-\x7FÀ-ÿ\u3000-\u9FFF]*$")

    def count(chars: Column) -> Column:
        return F.map_from_entries(F.transform(F.array_distinct(chars), lambda c: F.struct(c, F.size(F.filter(chars, lambda x: x == c)))))

    return F.when(plain, once(F.filter(F.split(F.lower(title), ""), lambda c: c != ""), count))


def title_bound(first: Column, second: Column) -> Column:
    """The most that ``title_similarity`` can be for titles with such ``letters``: by the characters that they share. 1 if unknown."""
    shared = F.aggregate(F.map_entries(first), F.lit(0), lambda n, e: n + F.least(e["value"], F.coalesce(F.try_element_at(second, e["key"]), F.lit(0))))
    total = lambda m: F.aggregate(F.map_values(m), F.lit(0), lambda n, v: n + v)
    return F.coalesce(F.try_divide(shared * 2.0, total(first) + total(second)), F.lit(1.0))


def title_similarity(first: Column, second: Column, least: Column | None = None) -> Column:
    """From 0 to 1; 0 if either is missing. It isn't symmetric: the earlier title comes first.

    Similarities under ``least`` may come out as 0, for most of them need no exact ratio. No built-in function equals it.
    It is marked as nondeterministic, so that a filter and a projection on it share one evaluation.
    """
    need = F.lit(0.0) if least is None else F.coalesce(least - F.lit(1e-9), F.lit(0.0))
    return F.arrow_udf(_ratio, "double").asNondeterministic()(first, second, need)
