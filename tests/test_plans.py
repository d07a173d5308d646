"""Physical-plan regressions: pruning, pushdown, broadcast of checked dims, no per-key windows."""
import contextlib
import io
import tempfile

import pytest

import __spark_entry__ as E
from gridtel.operators import silver
from gridtel.plans import layers

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def stored(spark):
    layers.materialize(spark, SF, tempfile.mkdtemp(prefix="gridtel-plan-") + "/L")
    yield
    layers.forget_materialized(SF)


def test_region_tsi_plan(spark, stored):
    p = plan(E.queries()["region_tsi"](spark, SF))
    nodes = [line for line in p.splitlines() if line.startswith("(")]
    assert sum("BroadcastHashJoin" in n for n in nodes) == 2
    fact_scan = [line for line in p.splitlines() if line.startswith("ReadSchema") and "thermal_stress_index" in line]
    assert fact_scan and "oil_level_percent" not in fact_scan[0] and "current_a" not in fact_scan[0]
    assert "Window" not in p


def test_window_lookup_pushdown(spark, stored):
    p = plan(E.queries()["telemetry_window"](spark, SF))
    assert "EqualTo(transformer_id,TR-00001)" in p
    assert "GreaterThanOrEqual(ts," in p and "LessThanOrEqual(ts," in p
    assert "TakeOrderedAndProject" in p


def test_dedup_is_an_aggregate(spark):
    from gridtel.operators.dedup import keep_first
    df = spark.range(1000).selectExpr("id % 7 AS k", "id AS t", "id * 2 AS v")
    p = plan(keep_first(df, ["k"], ["t"]))
    assert "Window" not in p
    assert p.count("HashAggregate") + p.count("ObjectHashAggregate") + p.count("SortAggregate") >= 2


def test_staging_deals_its_rows_once(spark):
    L = layers.Layers(spark, SF + "/")  # another name: nothing is stored for it
    staged = L.stg
    dealt = [line for line in plan(staged).splitlines() if "hashpartitioning(" in line and "_reg_id" not in line]
    assert len(dealt) == 1 and "timestamp" in dealt[0]
    again = silver.stg_telemetry(L.raw)  # from raw rows alone, by the payload's own text
    assert sorted(staged.columns) == sorted(again.columns)
    assert staged.count() > 0 and staged.exceptAll(again).isEmpty() and again.exceptAll(staged).isEmpty()


def test_a_task_reads_a_bounded_part_of_a_file(spark):
    from gridtel.session import apply_conf
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for given, wanted in (("128m", "16m"), ("1m", "1m")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", given)
            apply_conf(spark)
            assert spark.conf.get("spark.sql.files.maxPartitionBytes") == wanted
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
