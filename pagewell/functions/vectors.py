"""Vector arithmetic and the bracketed text form of vectors."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from pagewell.functions import let
from pagewell.settings import SCORE_DECIMALS


def inner_product(left: Column, right: Column) -> Column:
    """Sum of products in double; the cosine if both sides have unit length."""
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(vector: Column) -> Column:
    squares = F.aggregate(
        vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
    )
    return F.sqrt(squares)


def unit_vector(vector: Column) -> Column:
    """The vector over its length; a zero vector stays as it is."""
    return let(norm(vector), lambda length: F.when(
        length > 0, F.transform(vector, lambda x: (x.cast("double") / length).cast("float"))
    ).otherwise(vector))


def score(left: Column, right: Column) -> Column:
    """Inner product as reported in hits."""
    return F.round(inner_product(left, right), SCORE_DECIMALS)


def has_dimension(vector: Column, dim: int) -> Column:
    """False for NULL vectors, wrong sizes and vectors with an entry that is NULL,
    not a number or infinite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce((F.size(vector) == dim) & F.forall(vector, finite), F.lit(False))


def _as_text(column: pd.Series) -> pd.Series:
    return column.map(lambda v: None if v is None else "[" + ",".join([f"{x:g}" for x in v.tolist()]) + "]")


def vector_to_text(vector: Column) -> Column:
    """``[a,b,...]`` with six significant digits per entry, no trailing zeros and
    an exponent below 1e-4 and from 1e6 on. NULL entries are left out. One Arrow
    batch function: an expression per entry would be interpreted."""
    known = F.filter(vector.cast("array<double>"), lambda x: x.isNotNull())
    return F.pandas_udf(_as_text, "string")(known)


def text_to_vector(text: Column) -> Column:
    """The vector written by :func:`vector_to_text`; NULL if it does not parse."""
    return F.from_json(text, "array<float>")
