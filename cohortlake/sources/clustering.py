"""Write-time clustering: base tables stored so that readers can skip row groups.

The datasets compare some texts under a collation (case and trailing blanks do not count).
A reader cannot prune ``upper(rtrim(test_name)) = 'VIRAL LOAD'``: the file footers know the
least and greatest raw value of a row group only. So the collation key is made a column when
the table is written, and rows are range-distributed and sorted by it; a plain predicate on
that column is pushed to the reader, which skips every file and page without the family.

A family may hold a large part of the rows (viral loads among laboratory results),
so the range distribution goes on with the patient key: a common family
spreads over as many files as its rows ask for. Datasets use the key column where a table
has it and compare the text where it has not; results are the same.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.functions import ci, ci_in
from cohortlake.sources.sink import overwrite_table


@dataclass(frozen=True)
class Clustering:
    """``key``: the added column, the collation key of ``text``; ``spread``: columns that split a common key."""

    text: str
    key: str
    spread: tuple[str, ...]


#: Tables that are read by a text family, and how they are laid out.
CLUSTERED = {"ct_patient_labs": Clustering("test_name", "test_key", ("site_code", "patient_pk"))}


def with_key(df: DataFrame, by: Clustering) -> DataFrame:
    """``df`` with the collation key column, made anew if it is there."""
    return df.withColumn(by.key, ci(by.text))


def clustered(df: DataFrame, by: Clustering, partitions: int | None = None) -> DataFrame:
    """``df`` with the key column, range-distributed and sorted by it and the spread columns."""
    order = [by.key, *by.spread]
    keyed = with_key(df, by)
    dealt = keyed.repartitionByRange(*order) if partitions is None else keyed.repartitionByRange(partitions, *order)
    return dealt.sortWithinPartitions(*order)


def family(df: DataFrame, by: Clustering, names: Iterable[str]) -> Column:
    """Whether a row's text is one of ``names`` under the collation: a predicate on the
    key column, which the reader can push down, if ``df`` has it."""
    wanted = [n.rstrip().upper() for n in names]
    return F.col(by.key).isin(wanted) if by.key in df.columns else ci_in(by.text, wanted)


def write_base_table(df: DataFrame, base: str, name: str, partitions: int | None = None) -> str:
    """Write a base table to ``<base>/<name>.parquet``, clustered if it is one of ``CLUSTERED``."""
    path = f"{base.rstrip('/')}/{name}.parquet"
    if name in CLUSTERED:
        return overwrite_table(clustered(df, CLUSTERED[name], partitions), path)
    return overwrite_table(df, path, partitions)


def main(argv: list[str] | None = None) -> None:
    """``python -m cohortlake.sources.clustering --tables DIR --out DIR [--partitions N]``: clustered copies of the
    tables that are read by family; the others can be read where they are."""
    import argparse

    from pyspark.sql import SparkSession

    from cohortlake.session import with_settings
    from cohortlake.sources.tables import read_table

    p = argparse.ArgumentParser(description="Clustered copies of base tables")
    p.add_argument("--tables", required=True, help="folder with <table>.parquet base tables")
    p.add_argument("--out", required=True, help="folder for the clustered copies")
    p.add_argument("--partitions", type=int, help="files per table")
    args = p.parse_args(argv)
    spark = with_settings(SparkSession.builder).getOrCreate()
    for name in CLUSTERED:
        write_base_table(read_table(spark, args.tables, name), args.out, name, args.partitions)


if __name__ == "__main__":
    main()
