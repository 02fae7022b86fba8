"""Small helpers that several training-data operators share."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD_GAP = r"[\x20\x09-\x0D]+"
#: Copies that a joined table gets so that the rows of a hot key spread over as many tasks.
SALTS = 16


def words(text: Column) -> Column:
    """The words of a text as an array; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


def named(kind: str, columns: Iterable[str]) -> str:
    """A column name that none of ``columns`` has, whatever their case."""
    taken, name = {c.lower() for c in columns}, f"zp_{kind}"
    while name in taken:
        name += "_"
    return name


def is_held_out(doc_id: Column) -> Column:
    """The fixed third of documents whose labels are never learned from; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def held_out_id(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


def salted_join(rows: DataFrame, table: DataFrame, on: Callable[[DataFrame, DataFrame], Column], by: Column, how: str) -> DataFrame:
    """``rows`` joined with a small-rowed ``table`` so that one hot key is dealt over ``SALTS`` tasks.

    ``by`` spreads the rows of a key; every table row is repeated once per salt. The work grows with the
    rows and the table, not with the size of a group.
    """
    salt, copy = named("salt", [*rows.columns, *table.columns]), named("copy", [*rows.columns, *table.columns])
    left = rows.withColumn(salt, F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    right = table.withColumn(copy, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, on(left, right) & (left[salt] == right[copy]), how).drop(salt, copy)


def per_batch(make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: ``make`` runs once in a task and gives the function for its batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            yield step(batch)

    return run


def slices(batches: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in pieces, so that few rows at a time become Python objects; nothing is copied."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
