"""Price ranges as free text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

TIERS = ("budget", "mid", "premium", "luxury", "unknown")
# The upper ends of the tiers. The last one belongs to its tier, the others to the next.
BUDGET, MID, PREMIUM = 150_000, 300_000, 500_000


def price_lower_bound(text: Column) -> Column:
    """First run of digits after commas are removed; null without any."""
    return F.nullif(F.regexp_extract(F.replace(text, F.lit(",")), r"([0-9]+)", 1), F.lit("")).try_cast("decimal(38,0)")


def price_tier(text: Column) -> Column:
    low = price_lower_bound(text)
    return F.when(low.isNull(), "unknown").when(low < BUDGET, "budget").when(low < MID, "mid").when(low <= PREMIUM, "premium").otherwise("luxury")
