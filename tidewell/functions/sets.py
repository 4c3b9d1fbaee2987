"""Sets of strings in arrays."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def present(array: Column) -> Column:
    """The array without nulls; empty for a null."""
    return F.coalesce(F.array_compact(array), F.array().cast("array<string>"))


def lower_set(array: Column) -> Column:
    """Distinct elements in lower case."""
    return F.array_distinct(F.transform(present(array), F.lower))


def jaccard_of_sets(x: Column, y: Column) -> Column:
    """Similarity of two arrays that are sets; 0 if both are empty. The union's size follows from the intersection's."""
    both = F.size(F.array_intersect(x, y))
    return F.coalesce(F.try_divide(both.cast("double"), (F.size(x) + F.size(y) - both).cast("double")), F.lit(0.0))


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two string sets whatever the case."""
    return jaccard_of_sets(lower_set(a), lower_set(b))


def feature_categories(features: Column) -> Column:
    """Distinct nonblank categories of an array of feature structs; empty for a null."""
    categories = F.transform(features, lambda f: f["category"])
    return F.array_distinct(F.filter(present(categories), lambda c: c != ""))
