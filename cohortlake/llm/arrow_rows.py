"""Row-wise Python over Arrow batches: one place that appends result columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def append(df: DataFrame, column: str, fields: list[T.StructField], rows: Callable[[list], list[tuple]], drop: tuple[str, ...] = ()) -> DataFrame:
    """Add ``fields`` computed from one column; the other columns pass through
    untouched, and those named like a new field are replaced.

    ``rows`` takes a batch's values and returns one tuple per value. Memory is
    one Arrow batch; the result depends on nothing but the value, so a lost
    task is simply run again.
    """
    gone = {*drop, *(f.name for f in fields)}
    kept = [f for f in df.schema.fields if f.name not in gone]
    schema = T.StructType([*kept, *fields])
    at, names = df.columns.index(column), [f.name for f in schema.fields]
    types = [to_arrow_type(f.dataType) for f in fields]
    positions = [i for i, f in enumerate(df.schema.fields) if f.name not in gone]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                made = list(zip(*rows(part.column(at).to_pylist()), strict=True)) or [()] * len(types)
                new = [pa.array(list(v), t) for v, t in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in positions), *new], names)

    return df.mapInArrow(run, schema)
