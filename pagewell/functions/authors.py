"""The author list column, a JSON array of names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagewell.functions import let


def authors_by_comma(authors: Column) -> Column:
    """Cut at every comma after removing brackets and quotes.

    Blanks after a comma stay, a name with a comma becomes two, and an empty
    remainder after the last comma is no name. NULL and ``[]`` give no names.
    """
    bare = F.regexp_replace(authors, r"[\[\]]", "")

    def names(parts: Column) -> Column:
        kept = F.when(
            F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)
        ).otherwise(parts)
        return F.transform(kept, lambda name: F.replace(name, F.lit('"'), F.lit("")))

    return F.coalesce(let(F.split(bare, ","), names), F.array().cast("array<string>"))


def authors_from_json(authors: Column) -> Column:
    """The names as the JSON array lists them; NULL and bad JSON give none."""
    return F.coalesce(F.from_json(authors, "array<string>"), F.array().cast("array<string>"))
