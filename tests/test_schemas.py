"""The registry of base tables: casts that are checked, columns that are missing."""

import datetime as dt

import pytest

from cohortlake.sources.adapter import TABLES, FixtureTables
from cohortlake.sources.schemas import TABLE_COLUMNS, SchemaError, conform
from cohortlake.sources.tables import TableSet
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def test_the_fixture_tables_conform_unchanged(spark):
    fixtures = FixtureTables(spark, SF)
    assert set(TABLE_COLUMNS) == set(TABLES)
    for name in TABLES:
        df = getattr(fixtures, name)
        assert conform(df, name) is df, name


@pytest.mark.parametrize(("kind", "live"), [("string", ["0", " 0 ", "0.0"]), ("boolean", [False]), ("double", [0.0]), ("decimal(3,1)", [0]), ("tinyint", [0])])
def test_a_flag_of_another_type_is_cast(spark, kind, live):
    import decimal

    live = [decimal.Decimal(x) for x in live] if kind.startswith("decimal") else live
    df = spark.createDataFrame([(1, 2, 3, dt.date(2020, 1, 1), "x", v) for v in [*live, None]], f"site_code int, patient_pk bigint, visit_id bigint, visit_date date, tb_screening string, voided {kind}")
    out = conform(df, "ct_ipt")
    assert dict(out.dtypes)["voided"] == "int" and [r.voided for r in out.collect()] == [0] * len(live) + [None]


@pytest.mark.parametrize(("column", "kind", "bad"), [("voided", "string", "no"), ("voided", "string", "0.5"), ("patient_pk", "string", "12a"), ("visit_id", "double", 1.5), ("visit_date", "string", "yesterday")])
def test_a_value_that_cannot_be_cast_names_table_column_and_value(spark, column, kind, bad):
    types = {"site_code": "int", "patient_pk": "bigint", "visit_id": "bigint", "visit_date": "date", "tb_screening": "string", "voided": "int"} | {column: kind}
    row = {"site_code": 1, "patient_pk": 2, "visit_id": 3, "visit_date": dt.date(2020, 1, 1), "tb_screening": "x", "voided": 0} | {column: bad}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} {t}" for c, t in types.items()))
    with pytest.raises(Exception, match=f"ct_ipt.{column}: not a .*{bad}"):
        conform(df, "ct_ipt").collect()


def test_missing_columns_and_structures_fail_when_the_table_is_opened(spark, tmp_path):
    spark.sql("SELECT 1 AS site_code, 2L AS patient_pk, 3L AS visit_id").write.parquet(f"{tmp_path}/ct_ipt.parquet")
    with pytest.raises(SchemaError, match="ct_ipt lacks tb_screening, visit_date, voided"):
        TableSet(spark, str(tmp_path)).ct_ipt
    with pytest.raises(SchemaError, match="voided is array<int>"):
        conform(spark.sql("SELECT 1 AS site_code, 2L AS patient_pk, 3L AS visit_id, DATE'2020-01-01' AS visit_date, '' AS tb_screening, array(0) AS voided"), "ct_ipt")


def test_dates_with_a_time_of_day_and_unknown_columns_pass(spark):
    df = spark.sql("SELECT 1 AS site_code, 2 AS patient_pk, 3L AS art_id, TIMESTAMP'2020-01-01 10:00:00' AS start_art_date, 'x' AS more")
    assert conform(df, "mnch_arts") is df and rows(conform(df, "other")) == rows(df)
