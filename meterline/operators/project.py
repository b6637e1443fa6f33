"""Add computed columns that later filters reference without re-evaluating them.

Catalyst pushes a ``Filter`` below the ``Project`` that defines the column
it tests, and it does so by substituting the defining expression. A column
such as a parsed timestamp is then evaluated once in each filter that uses
it and once more in the output, because a filter does not share
subexpressions with the projection above it.

``with_columns_once`` emits the new columns from a one-element
``inline(array(struct(...)))`` generator. A predicate on a generator's
output cannot move below the generator, so the expression runs once per
row. Predicates on the input columns are still pushed below it, and down
into the scan. The generator emits exactly one row per input row and stays
inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_columns_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df.withColumns(columns)``, with each expression evaluated once per row."""
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
