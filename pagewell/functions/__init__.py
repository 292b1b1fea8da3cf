"""Column expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    An expression used several times below a lambda would otherwise be
    evaluated at every use; binding it as a lambda argument avoids that and
    keeps the whole thing one column.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def select_once(df: DataFrame, keep: list[str], *computed: Column) -> DataFrame:
    """``df.select(*keep, *computed)`` with ``computed`` evaluated once.

    A filter on a plain projected column is pushed below the projection, and
    then evaluates the column's expression again, once for every mention.
    Columns that come out of a generator are not rewritten that way. Worth it
    only for costly expressions.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*computed))))
