"""Deep pages equal the plain sort, and read only the parts that hold them."""
import random

import pytest
from pyspark.sql import functions as F

from gridtel.operators import paging

ORDER = [("ts", False), ("id", True)]
ROWS = [(i, random.Random(i).choice([None, 1, 2, 3, 50, 51, 52]), f"t{i}") for i in range(1000)]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    df = spark.createDataFrame(ROWS, "id long, ts int, n string").repartition(5)
    path = str(tmp_path_factory.mktemp("ranges")) + "/t"
    paging.sort_by_range(df, path, ORDER, rows_per_range=64)
    return df, path


@pytest.mark.parametrize("offset,n", [(0, 10), (1, 1), (63, 3), (500, 1000), (990, 100), (1000, 10), (5000, 10), (-3, 5), (777, None)])
def test_page_equals_sorted_slice(spark, table, offset, n):
    df, path = table
    want = sorted(ROWS, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    a, k = max(offset, 0), n or 100
    got = [tuple(r) for r in paging.page(spark, path, df.schema, ORDER, n, offset).collect()]
    assert got == want[a:a + k]


def test_page_reads_few_parts(spark, table):
    df, path = table
    deep = paging.page(spark, path, df.schema, ORDER, 10, 900)
    files = spark.read.parquet(f"{path}/rows").select(F.input_file_name()).distinct().count()
    assert files > 10
    read = deep._jdf.queryExecution().optimizedPlan().toString()
    assert "_range" in read
    plain = spark.read.parquet(f"{path}/rows")
    largest = plain.groupBy("_range").count().agg(F.max("count")).first()[0]
    assert largest < 250  # a part, not offset + n rows
    kept = deep._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in kept


def test_empty_table_and_reserved_column(spark, tmp_path):
    df = spark.createDataFrame([], "id long, ts int, n string")
    paging.sort_by_range(df, str(tmp_path / "t"), ORDER)
    page = paging.page(spark, str(tmp_path / "t"), df.schema, ORDER, 10, 5)
    assert page.collect() == [] and page.columns == ["id", "ts", "n"]
    with pytest.raises(ValueError, match="reserved"):
        paging.sort_by_range(df.withColumn("_range", F.lit(1)), str(tmp_path / "u"), ORDER)


def test_million_offset(spark, tmp_path):
    df = spark.range(1_200_000).select((F.lit(1_199_999) - F.col("id")).alias("id"))
    order = [("id", True)]
    paging.sort_by_range(df, str(tmp_path / "t"), order, rows_per_range=50_000)
    got = [r["id"] for r in paging.page(spark, str(tmp_path / "t"), df.schema, order, 20, 1_000_000).collect()]
    assert got == list(range(1_000_000, 1_000_020))
