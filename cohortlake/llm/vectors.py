"""Vectors as exact integers: floor(scale * component), each component taken as a double."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def whole(vector: Column) -> Column:
    """True where the vector is there and no component is null or non-finite."""
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def integers(df: DataFrame, scale: int, vec_id: str, vector: str, components: int | None = None) -> DataFrame:
    """(vec_id, x) of the whole vectors, those with ``components`` components if that is given."""
    x = F.col(vector).cast("array<double>")
    kept = whole(x) if components is None else whole(x) & (F.size(x) == components)
    return df.filter(kept).select(F.col(vec_id).alias("vec_id"), F.transform(x, lambda v: F.floor(v * scale)).alias("x"))


def matrix(column: pa.Array, components: int | None = None) -> np.ndarray:
    """One row per vector; without ``components`` as many as the longest has, shorter ones filled up with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    width = components if components is not None else int(lengths.max(initial=0))
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out
