"""Plan shaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame) -> DataFrame:
    """The same rows, with every column computed exactly once per row.

    Catalyst moves a later filter below the projection and repeats the parsing expressions in it, once
    per use; for wide parsed rows that is slow and can exceed the size limit of generated code. A
    filter does not move below a generator, and a one-element generator costs next to nothing.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{n}`") for n in df.columns]))))


def spread(names: Sequence[str], *rows: Sequence[Column], when: Sequence[Column | None] | None = None) -> Column:
    """Generator that turns each input row into the given rows, in one pass over the input.

    ``when`` holds one condition per row (None = always); rows whose condition fails are not produced.
    """
    made = [F.struct(*[c.alias(n) for n, c in zip(names, row, strict=True)]) for row in rows]
    if when is None:
        return F.inline(F.array(*made))
    kept = [row if ok is None else F.when(ok, row) for row, ok in zip(made, when, strict=True)]
    return F.inline(F.array_compact(F.array(*kept)))
