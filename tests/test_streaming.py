"""Streaming ingest equals the batch result; replay and CSV round trips keep every row."""
import __spark_entry__ as E
from gridtel.plans.layers import Layers

SF = "/root/testdata/sf0.001"


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_stream_equals_batch(spark):
    got = E.queries()["stream_ingest"](spark, SF)
    exp = Layers(spark, SF).measurements
    cols = exp.columns
    assert _rows(got, cols) == _rows(exp, cols)


def test_replay_equals_silver(spark):
    got = E.queries()["replay"](spark, SF)
    exp = Layers(spark, SF).stg
    cols = ["id", "transformer_id", "ts", "load_percent", "winding_temperature_c", "state", "quality_flag"]
    assert _rows(got, cols) == _rows(exp, cols)


def test_registry_csv_roundtrip(spark):
    got = E.queries()["registry_csv"](spark, SF)
    exp = Layers(spark, SF).registry
    cols = ["transformer_id", "frequency_hz", "cooling_type", "length_m", "width_m"]
    assert _rows(got, cols) == _rows(exp, cols)
    near = got.join(exp.select("transformer_id", exp.rated_power_mva.alias("was")), "transformer_id")
    assert near.where("abs(rated_power_mva - was) > 0.0500001").count() == 0


def test_stream_idempotence_restart_and_counters(spark, scratch):
    import os

    from pyspark.sql import functions as F

    from gridtel.streaming import ingest as stream

    L = Layers(spark, SF)
    landing, out = os.path.join(scratch, "landing"), os.path.join(scratch, "bronze")
    env = L.envelopes
    env.filter(F.year("received_at") < 1995).coalesce(1).write.json(landing + "/0001")
    env.filter(F.year("received_at") >= 1995).coalesce(1).write.json(landing + "/0002")
    ids = L.registry.select("transformer_id")
    q = stream.start_ingest(spark, landing + "/*", ids, out, checkpoint=os.path.join(scratch, "ck1"))
    q.awaitTermination()
    metrics = [p["observedMetrics"]["ingest_counters"] for p in q.recentProgress
               if p.get("observedMetrics", {}).get("ingest_counters")]
    assert sum(int(m["received"]) for m in metrics) == env.count()
    raw_n = stream.read_tables(spark, out)["raw"].count()
    meas = stream.read_tables(spark, out)["measurements"]
    assert raw_n == L.raw.count() and meas.count() == L.measurements.count()
    # a retried micro-batch (same id, same rows) replaces only its own partitions
    from gridtel.operators import contract
    retry = contract.validate(spark.read.schema(env.schema).json(landing + "/0001"), ids)
    stream.write_batch(retry, 0, out, run_id=stream.run_id_for(os.path.join(scratch, "ck1")))
    assert stream.read_tables(spark, out)["raw"].count() == raw_n
    # restart from an empty checkpoint: every file is read again, the backstop drops all of it
    q2 = stream.start_ingest(spark, landing + "/*", ids, out, checkpoint=os.path.join(scratch, "ck2"))
    q2.awaitTermination()
    t = stream.read_tables(spark, out)
    assert t["raw"].count() == raw_n
    dup = t["counters"].agg(F.sum("duplicates")).first()[0]
    assert dup >= L.raw.count()


def test_counters_listener(spark, scratch):
    import os
    import time

    from gridtel.streaming import ingest as stream

    L = Layers(spark, SF)
    landing = os.path.join(scratch, "landing")
    L.envelopes.coalesce(2).write.json(landing)
    listener = stream.CountersListener()
    spark.streams.addListener(listener)
    try:
        q = stream.start_ingest(spark, landing, L.registry.select("transformer_id"), os.path.join(scratch, "out"),
                                checkpoint=os.path.join(scratch, "ck"), max_files_per_trigger=1)
        q.awaitTermination()
        for _ in range(50):
            if listener.totals()["received"] == L.envelopes.count():
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    tot = listener.totals()
    assert tot["received"] == L.envelopes.count()
    assert tot["accepted"] + tot["rejected"] == tot["received"]


def _line(**change):
    import json
    body = {"schema_version": 1, "transformer_id": "TR-00001", "timestamp": "2026-01-01T00:00:10Z", "load_percent": 50.0,
            "ambient_temperature_c": 20.0, "oil_temperature_c": 50.0, "winding_temperature_c": 60.0,
            "oil_level_percent": 90.0, "current_a": 10.0, "voltage_kv": 69.0, "state": "NORMAL"} | change
    return json.dumps(body)


def test_one_instant_in_two_text_forms_is_one_measurement(spark, scratch):
    from gridtel.streaming import ingest as stream
    ids = spark.createDataFrame([("TR-00001",)], "transformer_id string")
    landing, out = scratch + "/landing", scratch + "/bronze"
    for i, ts in enumerate(("2026-01-01T00:00:10Z", "2026-01-01T00:00:10+00:00")):
        row = [("transformers/TR-00001/telemetry", _line(timestamp=ts), f"2026-01-01 00:00:1{i}")]
        spark.createDataFrame(row, "topic string, payload string, received_at string").coalesce(1).write.json(f"{landing}/{i}")
        stream.start_ingest(spark, landing + "/*", ids, out, checkpoint=scratch + "/ck").awaitTermination()
    tables = stream.read_tables(spark, out)
    assert tables["raw"].count() == 2 and tables["measurements"].count() == 1


def test_other_read_errors_are_raised(spark, scratch):
    import os

    import pytest

    from gridtel.streaming import ingest as stream
    assert stream._stored(spark, scratch + "/none") is None
    os.makedirs(scratch + "/broken")
    with open(scratch + "/broken/part-0.parquet", "w") as f:
        f.write("not parquet at all")
    with pytest.raises(Exception):
        stream._stored(spark, scratch + "/broken").count()


def test_a_batch_of_one_day_is_written_by_several_tasks(spark, scratch):
    from gridtel.streaming import ingest as stream
    df = spark.range(2000).selectExpr("id", "date'2026-01-01' as event_date") \
        .unionByName(spark.range(10).selectExpr("id", "date'2026-01-02' as event_date"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as if the batch were large
    try:
        stream.write_partitions(df, scratch + "/t", "run", 0, rows_per_file=100)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = spark.read.parquet(scratch + "/t").inputFiles()
    assert sum("2026-01-01" in f for f in files) > 4 and sum("2026-01-02" in f for f in files) == 1
    assert spark.read.parquet(scratch + "/t").count() == 2010


def test_mistyped_replay_lines(spark, scratch):
    import pytest

    from gridtel.sources import files
    good = _line()
    bad = [_line(load_percent="abc"), '{"id": "a", "schema_version": "one", "payload": {}}', "[1]", "nonsense",
           '{"id": "a", "schema_version": 1, "received_at": "soon", "payload": {}}']
    spark.createDataFrame([(v,) for v in [good, "", *bad]], "value string").coalesce(1).write.text(scratch + "/lines")
    with pytest.raises(files.ReplayError):
        files.read_bronze_lines(spark, scratch + "/lines")
    got = files.read_bronze_lines(spark, scratch + "/lines", strict=False)
    assert sorted(r[0] for r in got["malformed"].collect()) == sorted(bad)
    assert got["measurements"].count() == 1 and got["raw"].count() == 0


def test_backfill_twice_stores_once(spark, scratch):
    from gridtel.plans.catalog import ADAPTER_ID_PATTERN
    from gridtel.sources import files
    from gridtel.streaming.backfill import backfill
    L = Layers(spark, SF)
    files.export_registry(L.registry, scratch + "/csv", "csv")
    payload = L.first.select("schema_version", "transformer_id", "timestamp", "load_percent", "ambient_temperature_c",
                             "oil_temperature_c", "winding_temperature_c", "oil_level_percent", "current_a", "voltage_kv", "state")
    files.write_bronze_lines(L.raw, payload, scratch + "/dump")
    runs = [{r.what: r.n for r in backfill(spark, scratch + "/csv", scratch + "/dump", scratch + "/out", ADAPTER_ID_PATTERN)[1].collect()}
            for _ in range(2)]
    from gridtel.streaming import ingest as stream
    tables = stream.read_tables(spark, scratch + "/out")
    assert tables["raw"].count() == L.raw.count() and tables["measurements"].count() == L.measurements.count()
    assert runs[0] == {"transformers": L.registry.count(), "raw": L.raw.count(), "measurements": L.measurements.count()}


def _land(spark, landing, name, rows):
    """One landing file of (unit, timestamp, load, receive time) messages."""
    messages = [(f"transformers/{u}/telemetry", _line(transformer_id=u, timestamp=ts, load_percent=load), at) for u, ts, load, at in rows]
    spark.createDataFrame(messages, "topic string, payload string, received_at string").coalesce(1).write.json(f"{landing}/{name}")


def _counters(spark, out):
    from gridtel.streaming import ingest as stream
    return [r.asDict() for r in stream.read_tables(spark, out)["counters"].orderBy("run_id", "batch_id").collect()]


UNITS = "transformer_id string"


def test_redelivery_is_dropped_without_reading_bronze(spark, scratch, monkeypatch):
    from gridtel.streaming import ingest as stream

    def no_lookup(*a):
        raise AssertionError("bronze was read")
    monkeypatch.setattr(stream, "unseen", no_lookup)
    ids = spark.createDataFrame([("TR-00001",), ("TR-00002",)], UNITS)
    landing, out, ck = scratch + "/landing", scratch + "/bronze", scratch + "/ck"
    first = [("TR-00001", f"2026-01-01T00:00:{i:02d}Z", 10.0 + i, "2026-01-01 00:01:00") for i in range(20)]
    again = [(u, ts, 99.0, "2026-01-01 00:02:00") for u, ts, _, _ in first]
    new = [("TR-00002", "2026-01-01T00:00:05Z", 30.0, "2026-01-01 00:02:00"), ("TR-00001", "2026-01-01T00:00:03+00:00", 40.0, "2026-01-01 00:02:00"),
           ("TR-00009", "2026-01-01T00:00:05Z", 30.0, "2026-01-01 00:02:00"), ("TR-00002", "2026-01-01T00:00:05Z", 20.0, "2026-01-01 00:01:30")]
    for name, rows in (("1", first), ("2", again + new), ("3", first)):   # every start finds the state of the one before
        _land(spark, landing, name, rows)
        stream.start_ingest(spark, landing + "/*", ids, out, checkpoint=ck, buckets=2).awaitTermination()
    got = [(c["received"], c["accepted"], c["rejected"], c["stored"], c["duplicates"], c["looked_up"]) for c in _counters(spark, out)]
    assert got == [(20, 20, 0, 20, 0, 0), (24, 23, 1, 2, 21, 0), (20, 20, 0, 0, 20, 0)]
    tables = stream.read_tables(spark, out)
    assert tables["raw"].count() == 22 and tables["measurements"].count() == 21
    loads = {(r.transformer_id, r.ts.second): r.load_percent for r in tables["measurements"].collect()}
    assert loads[("TR-00001", 3)] == 13.0 and loads[("TR-00002", 5)] == 20.0   # first by receive time


def test_expired_state_falls_back_on_bronze(spark, scratch):
    import time

    from gridtel.streaming import ingest as stream
    ids = spark.createDataFrame([("TR-00001",)], UNITS)
    landing, out, ck = scratch + "/landing", scratch + "/bronze", scratch + "/ck"
    early = [("TR-00001", "2026-01-01T00:00:01Z", 10.0, "2026-01-01 00:01:00"), ("TR-00001", "2026-01-01T00:00:02Z", 11.0, "2026-01-01 00:01:00")]
    other = [("TR-00001", "2026-03-01T00:00:01Z", 12.0, "2026-03-01 00:01:00")]
    late = early + [("TR-00001", "2026-01-01T00:00:03Z", 13.0, "2026-03-02 00:00:00"), ("TR-00001", "2026-01-01T00:00:02+00:00", 14.0, "2026-03-02 00:00:00")]
    for name, rows in (("1", early), ("2", other), ("3", late), ("4", late)):
        _land(spark, landing, name, rows)
        stream.start_ingest(spark, landing + "/*", ids, out, checkpoint=ck, buckets=1, slice_seconds=86_400, horizon_ms=1).awaitTermination()
        time.sleep(0.1)
    got = [(c["stored"], c["duplicates"], c["looked_up"]) for c in _counters(spark, out)]
    assert got[0] == (2, 0, 0) and got[1] == (1, 0, 0) and got[2] == (2, 2, 4) and got[3][:2] == (0, 4)
    tables = stream.read_tables(spark, out)
    assert tables["raw"].count() == 5 and tables["measurements"].count() == 4


def test_registry_files_in_name_and_line_order(spark, scratch):
    import os

    from gridtel.plans.catalog import ADAPTER_ID_PATTERN
    from gridtel.streaming.backfill import backfill
    L = Layers(spark, SF)
    row = L.registry.limit(1).toPandas()
    os.makedirs(scratch + "/csv")

    def put(name, impedances):
        import pandas as pd
        pd.concat([row.assign(impedance_percent=i) for i in impedances]).to_csv(f"{scratch}/csv/{name}", index=False)
    put("part-0.csv", [9.0])                       # small, so Spark packs it behind the large one
    put("part-1.csv", [5.0] * 199 + [6.5])
    empty = spark.createDataFrame([(_line(transformer_id=row.transformer_id[0]),)], "value string")
    empty.coalesce(1).write.text(scratch + "/dump")
    registry, _ = backfill(spark, scratch + "/csv", scratch + "/dump", scratch + "/out", ADAPTER_ID_PATTERN)
    assert [r.impedance_percent for r in registry.collect()] == [6.5]


def test_undated_raw_records_are_stored_once(spark, scratch):
    import json

    from gridtel.plans.catalog import ADAPTER_ID_PATTERN
    from gridtel.sources import files
    from gridtel.streaming import ingest as stream
    from gridtel.streaming.backfill import backfill
    files.export_registry(Layers(spark, SF).registry, scratch + "/csv", "csv")
    unit = Layers(spark, SF).registry.first().transformer_id
    record = {"id": f"{unit}@yesterday", "transformer_id": unit, "schema_version": 1, "topic": "t", "source": "mqtt",
              "received_at": "2026-01-01T00:00:00Z", "payload": {"timestamp": "yesterday"}}
    spark.createDataFrame([(json.dumps(record),)], "value string").coalesce(1).write.text(scratch + "/dump1")
    spark.createDataFrame([(json.dumps(record),)], "value string").coalesce(1).write.text(scratch + "/dump2")
    for dump in ("/dump1", "/dump2"):
        backfill(spark, scratch + "/csv", scratch + dump, scratch + "/out", ADAPTER_ID_PATTERN)
    assert stream.read_tables(spark, scratch + "/out")["raw"].count() == 1


def test_bronze_dump_is_compressed(spark, scratch):
    """Both kinds of line are kept in gzip files, and read back as they were."""
    import glob

    from gridtel.plans.layers import Layers
    from gridtel.sources import files
    L = Layers(spark, SF)
    first = L.first.limit(50).cache()
    from gridtel.operators import ingest
    files.write_bronze_lines(ingest.raw_records(first), first, scratch + "/dump")
    parts = glob.glob(scratch + "/dump/part-*")
    assert parts and all(p.endswith(".gz") for p in parts)
    got = files.read_bronze_lines(spark, scratch + "/dump")
    assert got["raw"].count() == got["measurements"].count() == 50


def test_packed_rows_come_back_whole(spark):
    """What passes through the state as one text keeps every value, and its instants to the microsecond."""
    from gridtel.streaming import delivery_state as D
    df = spark.sql("""select *, timestamp_micros(us) as at from values
        ('a"\\\\b{', 1L, double('NaN'), 1), ('', -1L, 4.9E-324D, null), ('é😀', 253402300799999999L, null, 3), (null, null, -0.0D, 4)
        as v(text, us, number, whole)""")
    back = D.unpack(df.select(D.pack(df).alias("_row"), df.whole.alias("kept")), "_row", df.schema.fields)
    assert back.columns == df.columns + ["kept"]
    as_text = lambda d: sorted(str(r) for r in d.selectExpr("text", "us", "number", "whole", "unix_micros(at)").collect())
    assert as_text(back) == as_text(df)
    at = [r[0] for r in df.where("us = 1").select(D._instant_text("text", "at")).collect()]
    assert at == ['a"\\b{@1970-01-01T00:00:00.000001+00:00']


def test_landings_are_compressed_and_their_shuffles_go(spark):
    import glob
    import time

    from gridtel.session import checkpoint_dir
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {n for f in [disk.getAllFiles()] for i in range(f.size()) if "shuffle" in (n := f.apply(i).getName())}
    base = checkpoint_dir(spark).removeprefix("file:")
    old, landed = shuffles(), set(glob.glob(f"{base}/landing-*"))
    E.queries()["stream_ingest"](spark, SF)
    (landing,) = set(glob.glob(f"{base}/landing-*")) - landed
    files = glob.glob(f"{landing}/*/part-*")
    assert files and all(f.endswith(".json.gz") for f in files)
    for _ in range(50):
        left = shuffles() - old
        if not left:
            break
        time.sleep(0.2)
    assert not left


def test_dump_in_one_pass_and_lines_parsed_once(spark, scratch):
    from gridtel import schemas as S
    from gridtel.operators import ingest
    from gridtel.sources import files
    L = Layers(spark, SF)
    fields = [n for n, _ in S.PAYLOAD_FIELDS]
    files.write_bronze_lines(L.raw, L.first.select(*fields), scratch + "/two")
    files.write_bronze_lines(ingest.raw_records(L.first, L.source, [f for f in fields if f not in L.raw.columns]), None, scratch + "/one")
    lines = [sorted(r[0] for r in spark.read.text(scratch + d).collect()) for d in ("/one", "/two")]
    assert lines[0] == lines[1] and len(lines[0]) == 2 * L.raw.count()
    got = files.read_bronze_lines(spark, scratch + "/one")
    for kind in ("raw", "measurements"):   # what reads them reads columns, not lines
        plan = got[kind]._jdf.queryExecution().optimizedPlan().toString()
        assert "from_json" not in plan and "json_object" not in plan
        assert got[kind].count() == L.raw.count()
