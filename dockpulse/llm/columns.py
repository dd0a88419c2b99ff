"""Rows with columns of any names."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole_row(df: DataFrame) -> Column:
    """All columns as one, so that none can clash with a name of the operator's; ``select("row.*")`` brings them back."""
    return F.struct(*(F.col(f"`{c.replace('`', '``')}`") for c in df.columns)).alias("row")


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Small parts of batches, so that a task holds few rows as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def filtered(docs: DataFrame, keep: Callable[[list[str | None]], list[bool]]) -> DataFrame:
    """The rows whose texts ``keep`` says yes to, with all their columns.  Nothing is shuffled."""
    at, names = docs.columns.index("text"), docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            yield batch.filter(pa.array(keep(batch.column(at).to_pylist()), pa.bool_()))

    return plain.mapInArrow(run, plain.schema).toDF(*names)
