"""Tables whose rows pack well: one row group of them must not be one task."""

import pytest
from pyspark.sql import functions as F

from checks import fixtures
from checks.index_queries import part_records
from checks.match_queries import _people
from sparkloom.operators.scale import dealt

ROWS = 25_000


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("one_file"))
    texts = [F.lit(v).alias(c) for c, v in (("p_name", "red bolt"), ("p_brand", "Brand#1"), ("p_type", "SMALL"))]
    key = F.when(F.col("id") % 50 > 0, F.col("id")).alias("p_partkey")
    spark.range(0, ROWS, 1, 1).select(key, *texts, F.pmod("id", F.lit(50)).alias("p_size")).write.parquet(f"{path}/part.parquet")
    return path


def _sizes(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


@pytest.mark.parametrize("rows", [part_records, fixtures.html, lambda *a: _people(*a)[0], lambda *a: _people(*a)[1]], ids=["records", "pages", "left", "right"])
def test_short_rows_are_dealt(spark, folder, rows):
    sizes = _sizes(rows(spark, folder))
    assert sum(sizes) == ROWS and len(sizes) == 3 and max(sizes) < 12_000


def test_dealt_keeps_rows(spark, folder):
    part = spark.read.parquet(f"{folder}/part.parquet")
    assert dealt(part, 1000).exceptAll(part).count() == 0 and len(_sizes(dealt(part, 1000))) == 25
    assert dealt(part, ROWS) is part and dealt(part.limit(0)).count() == 0
