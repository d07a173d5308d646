"""M6 on a stream: the thermal lag model goes on, reading by reading, from what each unit's state holds.

State per unit: instant, oil and winding after its last reading.  Units are grouped in ``buckets`` by a hash of their
id; the states of a bucket's units are one value in RocksDB, read and written once per micro-batch, and the
model runs over all units of a bucket at once (``operators.lag.follow_units``).  A stream that follows a batch build takes
its first state from ``operators.lag.final_states`` of the batch result.  Readings of one micro-batch are taken in the
batch order (instant, load, ambient).  A reading older than the unit's last one moves nothing back: it counts as a
gap of zero, so a stream equals the batch result when landings arrive in the order of their instants.

The number of buckets bounds what a task holds at once, a bucket's readings of one micro-batch; it belongs to the
checkpoint, as the state is kept by bucket.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.lag import COLUMNS, LAG_SCHEMA, ROW_ORDER, begins, follow_units, seconds_of
from ..operators.thermal import with_design
from .delivery_state import stream_settings

BUCKETS = 512
NEW = (np.nan, np.nan, np.nan)  # a unit without a state


class UnitsLag(StatefulProcessor):
    """The lag model of one bucket's units."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "units array<string>, seconds array<double>, oil array<double>, winding array<double>")

    def _held(self) -> dict[str, tuple]:
        if not self.last.exists():
            return {}
        units, *values = self.last.get()
        return dict(zip(units, zip(*values)))

    def _keep(self, held: dict[str, tuple]) -> None:
        if held:
            self.last.update((list(held), *[list(map(float, v)) for v in zip(*held.values())]))

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        held = self._held()
        held.update(zip(initialState["transformer_id"], zip(seconds_of(initialState["ts"]), initialState["oil"], initialState["winding"])))
        self._keep(held)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self._held()
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(["transformer_id", *ROW_ORDER], kind="stable", ignore_index=True)
        unit, t = pdf["transformer_id"].to_numpy(), seconds_of(pdf["ts"])
        start = begins(unit)
        entering = np.array([held.get(u, NEW) for u in unit[start]], float).reshape(-1, 3)
        t = np.fmax(t, np.repeat(entering[:, 0], np.diff(np.append(np.flatnonzero(start), len(t)))))
        oil, winding = follow_units(pdf, t, start, entering, by_unit=True)
        last = np.append(start[1:], True)
        held.update(zip(unit[last], zip(t[last], oil[last], winding[last])))
        self._keep(held)
        yield pdf[["transformer_id", "ts", "ambient_temperature_c", "load_percent"]].assign(
            model_oil_c=np.round(oil, 6), model_winding_c=np.round(winding, 6))

    def close(self) -> None:
        pass


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("transformer_id"), F.lit(buckets)).cast("int").alias("_bucket")


def thermal_lag_stream(measurements: DataFrame, registry: DataFrame, initial: DataFrame | None = None,
                       buckets: int = BUCKETS) -> DataFrame:
    """The model's rows for a stream of measurements; start the query inside ``stream_settings``.

    ``initial`` holds (transformer_id, ts, oil, winding) of units whose history a batch has modelled.
    """
    rows = with_design(measurements, registry).select(_bucket(buckets), *COLUMNS)
    return rows.groupBy("_bucket").transformWithStateInPandas(
        statefulProcessor=UnitsLag(), outputStructType=LAG_SCHEMA, outputMode="Append", timeMode="None",
        initialState=None if initial is None else initial.select(_bucket(buckets), "*").groupBy("_bucket"))


def start(spark, measurements: DataFrame, registry: DataFrame, out: str, checkpoint: str, initial: DataFrame | None = None,
          available_now: bool = True, buckets: int = BUCKETS):
    """Append the model's rows to Parquet files under ``out``; returns the ``StreamingQuery``."""
    writer = thermal_lag_stream(measurements, registry, initial, buckets).writeStream.format("parquet") \
        .option("path", out).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    with stream_settings(spark):
        return writer.start()
