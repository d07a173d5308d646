"""Versions are seen whole or not at all; views and SQL functions match the DataFrame results."""
import os

import pytest
from pyspark.sql import functions as F

from gridtel.functions import measures, timefmt
from gridtel.plans import published
from gridtel.plans.layers import Layers
from gridtel.plans.views import VIEWS, create_functions, create_views

SF = "/root/testdata/sf0.001"


def test_readers_stay_on_their_version(spark, scratch):
    base = scratch + "/tables"
    assert published.current_version(spark, base) is None
    with pytest.raises(FileNotFoundError):
        published.Snapshot(spark, base)
    first = published.publish({"a": spark.range(3), "b": spark.range(5)}, base, sort={"a": ("id",)})
    reader = published.Snapshot(spark, base)
    second = published.publish({"a": spark.range(30), "b": spark.range(50)}, base)
    assert second > first and reader.version == first and reader.table("a").count() == 3
    assert published.Snapshot(spark, base).table("b").count() == 50


def test_a_failed_write_changes_nothing(spark, scratch):
    base = scratch + "/tables"
    published.publish({"a": spark.range(3), "b": spark.range(5)}, base)
    broken = spark.range(4).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception):
        published.publish({"a": spark.range(9), "b": broken}, base)
    now = published.Snapshot(spark, base)
    assert (now.table("a").count(), now.table("b").count()) == (3, 5)
    assert len(os.listdir(base + "/versions")) == 2
    assert len(published.expire(spark, base, keep_seconds=-1)) == 1 and now.table("a").count() == 3


def test_old_versions_go_after_a_time(spark, scratch):
    base = scratch + "/tables"
    versions = [published.publish({"a": spark.range(i)}, base) for i in (1, 2, 3)]
    assert published.expire(spark, base, keep_seconds=3600) == []
    assert published.expire(spark, base, keep_seconds=-1) == versions[:2]
    assert published.Snapshot(spark, base).table("a").count() == 3


def test_functions_match_the_columns(spark):
    create_functions(spark)
    rows = spark.createDataFrame([(w, o, x) for w in (None, -3.0, 93.0, 95.0, 105.0) for o in (None, 40.05, 90.0, 100.0)
                                  for x in (None, 0.0, 100.0, 100.5, 140.0)], "w double, o double, l double")
    bad = rows.select(F.expr("thermal_stress_index(w, o, l)").alias("s"), measures.thermal_stress_index("w", "o", "l").alias("t"),
                      F.expr("classify_state(w, o, l)").alias("c"), measures.classify_state("w", "o", "l").alias("d")) \
        .where("NOT (s <=> t) OR NOT (c <=> d)")
    assert bad.count() == 0
    texts = spark.createDataFrame([("2026-01-01T00:00:10.9Z",), ("2026-01-01",), ("2026-01-01T00:00:10+02:00",), (None,), ("2026-13-01T00:00:10Z",)], "x string")
    assert texts.select(F.expr("normalize_ts(x)").alias("a"), timefmt.normalize_ts("x").alias("b")).where("NOT (a <=> b)").count() == 0
    assert spark.sql("""SELECT payload_field('{"a": 812.0, "b": null}', 'a') AS a, payload_field('{"b": null}', 'b') AS b""").first() == ("812.0", None)


def test_statements_over_views(spark):
    layers = Layers(spark, SF)
    create_views(layers)
    assert {t.name for t in spark.catalog.listTables()} >= set(VIEWS)
    from gridtel.operators import analytics
    got = spark.sql("SELECT transformer_id, count(*) AS n FROM measurements GROUP BY 1 ORDER BY n DESC, 1 LIMIT 5").collect()
    assert [tuple(r) for r in got] == [(r.transformer_id, r.n) for r in analytics.top_units(layers.measurements).collect()]
    peak = spark.sql("SELECT weekday, max(load_percent) AS peak_load FROM fact_transformer_measurement JOIN dim_time USING (time_key) GROUP BY 1")
    assert sorted(peak.collect()) == sorted(analytics.weekday_peak(layers.fact, layers.dim_time).select("weekday", "peak_load").collect())
    region = spark.sql("""SELECT region, application, count(*) AS n FROM fact_transformer_measurement
        JOIN dim_location USING (location_key) JOIN dim_transformer USING (transformer_key) GROUP BY 1, 2""")
    want = analytics.region_oil(layers.fact, layers.dim_transformer, layers.dim_location).select("region", "application", "n")
    assert sorted(region.collect()) == sorted(want.collect())
