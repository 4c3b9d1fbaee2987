"""Dates: ISO strings, windows, and the stamps of Chinese publishers (Beijing time)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import once

BEIJING = "+08:00"
# The characters that stand for year, month and day, and the words for spans of time before now.
YEAR, MONTH, DAY = "年", "月", "日"
AGO = {"minutes": "分钟前", "hours": "小时前", "days": "天前"}
#: What stands between the numbers of a date, and after the last one.
SIGNS, DASHES, SHORT_SIGNS = (YEAR, MONTH, DAY), ("-", "-", ""), (MONTH, DAY)


def parse_iso(text: Column, naive: str = "UTC") -> Column:
    """Timestamp of an ISO date or date-time string; null if blank or anything else. Without a zone it is ``naive``."""
    dashed = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{1,6})?)?)?(Z|[+-]\d{2}:?\d{2})?)?$"), text)
    packed = F.when(text.rlike(r"^\d{8}$"), text)
    padded = F.regexp_replace(F.replace(dashed, F.lit(","), F.lit(".")), r"^(\d{4}-\d{2}-\d{2}[T ]\d{2})(Z|[+-].*)?$", "$1:00$2")
    stamp = F.coalesce(F.try_to_timestamp(padded), F.try_to_timestamp(packed, F.lit("yyyyMMdd")))
    if naive == "UTC":
        return stamp
    zoned = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & text.rlike(r"[T ]\d{2}")
    return F.when(zoned, stamp).otherwise(F.to_utc_timestamp(stamp, naive))


def resolve_date(*candidates: Column) -> Column:
    """The first that is there: publication before scraping."""
    return F.coalesce(*candidates)


def within_hours(a: Column, b: Column, hours: int) -> Column:
    """At most so many hours apart, to the microsecond and both ends included; false if either is null."""
    span = F.make_interval(hours=F.lit(hours))
    return F.coalesce(b.between(a - span, a + span), F.lit(False))


def _tokens(text: Column) -> Column:
    """The text as runs of digits and what stands between them."""
    return F.regexp_extract_all(text, F.lit(r"([0-9]+|[^0-9]+)"), 1)


def _is_number(token: Column, least: int = 1, most: int | None = None) -> Column:
    n = F.length(token)
    return (F.substring(token, 1, 1).between("0", "9")) & (n >= least) & (n <= most if most else F.lit(True))


def _is_date(t: Column, i: Column, marks: tuple[str, ...], first: int) -> Column:
    """Do numbers and ``marks`` follow each other from token ``i`` on? The first has so many digits or more, the others one or two."""
    ok = _is_number(F.get(t, i), first)
    for k, mark in enumerate(marks):
        last = k == len(marks) - 1
        if k:
            ok &= _is_number(F.get(t, i + 2 * k), 1, None if last and not mark else 2)
        if mark:
            after = F.get(t, i + 2 * k + 1)
            ok &= F.startswith(after, F.lit(mark)) if last else after == mark
    return ok


def _clock(t: Column, i: Column, seconds: bool) -> Column:
    """Hour, minute and second at token ``i``; null if no time of day stands there."""
    colon = lambda k: F.get(t, i + k) == ":"
    is_time = _is_number(F.get(t, i), 1, 2) & colon(1) & _is_number(F.get(t, i + 2), 2)
    second = F.when(_is_number(F.get(t, i + 2), 2, 2) & colon(3) & _is_number(F.get(t, i + 4), 2), F.left(F.get(t, i + 4), F.lit(2))) if seconds else F.lit(None).cast("string")
    return F.when(F.coalesce(is_time, F.lit(False)), F.array(F.get(t, i), F.left(F.get(t, i + 2), F.lit(2)), second))


def _stamp(text: Column, marks: tuple[str, ...], seconds: bool = False) -> Column:
    """The first date of such a form in the text: year (if the form has one), month, day, hour, minute, second as strings; null without one."""
    first = 4 if len(marks) == 3 else 1

    def read(t: Column, i: Column) -> Column:
        end = i + 2 * len(marks) - 1
        head = F.right(F.get(t, i), F.lit(4 if first == 4 else 2))
        rest = [F.get(t, i + 2 * k) for k in range(1, len(marks))]
        gap = F.get(t, end)
        if marks[-1]:
            joined = F.regexp_replace(gap, r"\s+$", "") == marks[-1]
        else:
            joined = gap.isin(" ", "T") & (F.length(rest[-1]) <= 2)
        clock = F.coalesce(F.when(joined, _clock(t, end + 1, seconds)), F.array(*[F.lit(None).cast("string")] * 3))
        return F.concat(F.array(head, *rest[:-1], F.left(rest[-1], F.lit(2))), clock)

    def find(t: Column) -> Column:
        places = F.filter(F.transform(t, lambda _, i: i), lambda i: _is_date(t, i, marks, first))
        return once(F.get(places, 0), lambda i: F.when(i.isNotNull(), read(t, i)))

    return once(_tokens(text), find)


def _beijing(year: Column, parts: list[Column]) -> Column:
    month, day, *clock = (p.try_cast("int") for p in parts)
    return F.to_utc_timestamp(F.try_make_timestamp(year, month, day, *(F.coalesce(c, F.lit(0)) for c in clock)), BEIJING)


def _moment(stamp: Column) -> Column:
    return once(stamp, lambda s: _beijing(F.get(s, 0).try_cast("int"), [F.get(s, k) for k in range(1, 6)]))


def absolute_date(text: Column, seconds: bool = False) -> Column:
    """First full date in the text, as a timestamp: with signs, else with dashes. ``seconds``: dashes only, with seconds if given.

    A clock follows the date after white space (signs) or one space or T (dashes). A form that is there but names no day
    of the calendar gives null.
    """
    dashed = _stamp(text, DASHES, seconds)
    if seconds:
        return _moment(dashed)
    return _moment(F.coalesce(_stamp(text, SIGNS), dashed))


def relative_date(text: Column, as_of: Column) -> Column:
    """So many minutes, hours or days ago, or yesterday, before ``as_of``. Counts of over six digits are no span of time."""

    def count(t: Column, word: str) -> Column:
        places = F.filter(F.transform(t, lambda _, i: i), lambda i: _is_number(F.get(t, i), 1, 6) & F.startswith(F.regexp_replace(F.get(t, i + 1), r"^\s+", ""), F.lit(word)))
        return F.get(t, F.get(places, 0))

    def before(t: Column) -> Column:
        out = F.lit(None).cast("timestamp")
        for unit, word in reversed(AGO.items()):
            n = F.coalesce(count(t, word).try_cast("int"), F.lit(0))
            span = {"minutes": F.make_interval(mins=n), "hours": F.make_interval(hours=n), "days": F.make_interval(days=n)}[unit]
            out = F.when(count(t, word).isNotNull(), as_of - span).otherwise(out)
        return out

    return F.coalesce(once(_tokens(text), before), F.when(F.contains(text, F.lit("昨天")), as_of - F.make_interval(days=F.lit(1))))


def _without_year(stamp: Column, as_of: Column, ahead: int) -> Column:
    """In the current Beijing year, or in the one before if that is more than so many days ahead."""
    year = F.year(F.from_utc_timestamp(as_of, BEIJING))

    def of(s: Column) -> Column:
        parts = [F.get(s, k) for k in range(5)]
        this = _beijing(year, parts)
        return F.when(this > as_of + F.make_interval(days=F.lit(ahead)), _beijing(year - 1, parts)).otherwise(this)

    return once(stamp, of)


def month_day(text: Column, as_of: Column) -> Column:
    """A date without a year: the current Beijing year, or the one before if that lies in the future."""
    return _without_year(_stamp(text, SHORT_SIGNS), as_of, 0)


def dashed_month_day(text: Column, as_of: Column) -> Column:
    """``MM-DD``, one or two digits each, in the current Beijing year, or the one before if that is more than a day ahead."""

    def find(t: Column) -> Column:
        two = lambda i: _is_number(F.get(t, i), 1, 2)
        at = F.get(F.filter(F.transform(t, lambda _, i: i), lambda i: two(i) & (F.get(t, i + 1) == "-") & two(i + 2)), 0)
        return F.when(at.isNotNull(), F.array(F.get(t, at), F.get(t, at + 2)))

    return _without_year(once(_tokens(text), find), as_of, 1)


def result_date(text: Column, as_of: Column) -> Column:
    """Listing date: relative, else absolute, else without a year."""
    full = F.coalesce(_stamp(text, SIGNS), _stamp(text, DASHES))
    return F.coalesce(relative_date(text, as_of), F.when(full.isNotNull(), _moment(full)).otherwise(month_day(text, as_of)))


def note_date(text: Column, as_of: Column) -> Column:
    """Date of a social note: relative, today, absolute with seconds, or month and day."""
    return F.coalesce(relative_date(text, as_of), F.when(F.contains(text, F.lit("今天")), as_of), absolute_date(text, seconds=True), dashed_month_day(text, as_of))


def epoch_millis(value: Column) -> Column:
    """Timestamp of milliseconds since 1970, in whole seconds."""
    return F.timestamp_seconds(F.floor(value.cast("long") / F.lit(1000)))


def epoch_millis_or_seconds(value: Column) -> Column:
    """Values from 1e12 on are milliseconds; zero and negative ones are nothing."""
    number = value.cast("double")
    return F.when(number >= 1e12, F.timestamp_seconds(number / 1000)).when(number > 0, F.timestamp_seconds(number))
