"""Column names in the two conventions, top level only."""

from itertools import groupby

from pyspark.sql import DataFrame


def snake_to_camel(name: str) -> str:
    """Words after the first begin with a capital and go on in lower case."""
    words = name.split("_")
    return words[0] + "".join(w[:1].upper() + w[1:].lower() for w in words[1:])


def camel_to_snake(name: str) -> str:
    """Each capital but a leading one begins a word."""
    out = ""
    for capital, run in groupby(name, lambda c: "A" <= c <= "Z"):
        letters = "".join(run)
        out += "".join(f"_{c}" for c in letters) if capital else letters
    return (out[1:] if name[:1] == out[1:2] and out[:1] == "_" and name[:1] != "_" else out).lower()


def to_camel(df: DataFrame) -> DataFrame:
    return df.toDF(*map(snake_to_camel, df.columns))


def to_snake(df: DataFrame) -> DataFrame:
    return df.toDF(*map(camel_to_snake, df.columns))
