"""M6 first-order thermal lag as a scan: modelled top-oil and winding temperature per reading.

The state starts at a unit's first ambient temperature and moves toward the
steady targets with tau_oil = 90 min and tau_winding = 7 min over the real gaps
between readings.  Each step is affine in the state, ``y' = a y + b``, and a
run of steps is composed by doubling: log2(n) vector passes over a batch, no
loop over rows.

Rows are range-partitioned by (unit, instant), so pieces hold about equally
many rows and a unit with a third of them spreads over many pieces, whatever
its days hold.  Only the edges of the pieces and one affine map per piece (two
small tables, as many rows as pieces) pass through the driver, which chains
them; then every piece replays its rows from the state that enters it.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..session import cut_lineage

LAG_SCHEMA = ("transformer_id string, ts timestamp, ambient_temperature_c double, load_percent double, "
              "model_oil_c double, model_winding_c double")
ROW_ORDER = ("ts", "load_percent", "ambient_temperature_c")
COLUMNS = ("transformer_id", "ts", "ambient_temperature_c", "load_percent", "loss_ratio", "oil_rise_c", "winding_grad_c")


@dataclass
class State:
    """A unit's model between two readings."""
    unit: str
    seconds: float
    oil: float
    winding: float


def scan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All y_i = a_i y_(i-1) + b_i from y = 0, by composing neighbouring maps over doubling distances."""
    a, b = a.copy(), b.copy()
    d = 1
    while d < len(a) and a[d:].any():
        b[d:] += a[d:] * b[:-d]
        a[d:] *= a[:-d].copy()
        d *= 2
    return b


def seconds_of(ts: pd.Series) -> np.ndarray:
    return pd.to_datetime(ts).dt.as_unit("ns").astype("int64").to_numpy() / 1e9


def targets(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Steady top-oil temperature and winding rise over oil of every row (M4, M5)."""
    k = pdf["load_percent"].to_numpy() / 100.0
    ambient, r = pdf["ambient_temperature_c"].to_numpy(), pdf["loss_ratio"].to_numpy()
    kp = np.maximum(k, 0.0)
    oil = np.where(k <= 0, ambient, ambient + pdf["oil_rise_c"].to_numpy() * ((1 + r * kp * kp) / (1 + r)) ** 0.8)
    return oil, np.where(k <= 0, 0.0, pdf["winding_grad_c"].to_numpy() * kp ** 1.6)


def begins(unit: np.ndarray) -> np.ndarray:
    """Whether a row of sorted rows is the first of its unit."""
    start = np.ones(len(unit), bool)
    start[1:] = unit[1:] != unit[:-1]
    return start


def scan_units(a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
    """``scan`` of every unit's rows: what is no number stays within its unit, as such units are taken one by one."""
    begin = np.flatnonzero(start)
    sizes = np.diff(np.append(begin, len(b)))
    odd = np.logical_or.reduceat(~np.isfinite(b), begin)
    plain = ~np.repeat(odd, sizes)
    out = np.empty_like(b)
    out[plain] = scan(a[plain], b[plain])
    for i in np.flatnonzero(odd):
        own = slice(begin[i], begin[i] + sizes[i])
        out[own] = scan(a[own], b[own])
    return out


def follow_units(pdf: pd.DataFrame, t: np.ndarray, start: np.ndarray, entering: np.ndarray,
                 by_unit: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Oil and winding after every row of sorted rows at the times ``t``, with ``by_unit`` by ``scan_units``.

    ``entering`` has a row (seconds, oil, winding) per unit, in order of the units' first rows ``start``: the state that a
    unit goes on from, or no numbers when it begins here.
    """
    goes_on = ~np.isnan(entering[:, 0])
    previous = np.append(t[:1], t[:-1])
    previous[start] = np.where(goes_on, entering[:, 0], t[start])
    dt = np.maximum(t - previous, 0.0)
    oil_target, rise = targets(pdf)
    ambient = pdf["ambient_temperature_c"].to_numpy()[start]

    def follow(tau, target, held):
        a = np.exp(-dt / tau)
        b = (1 - a) * target
        b[start] += a[start] * np.where(goes_on, held, ambient)
        a[start] = 0.0
        return scan_units(a, b, start) if by_unit else scan(a, b)

    oil = follow(P.OIL_TIME_CONSTANT_S, oil_target, entering[:, 1])
    return oil, follow(P.WINDING_TIME_CONSTANT_S, oil + rise, entering[:, 2])


def model(pdf: pd.DataFrame, enters: State | None) -> tuple[np.ndarray, np.ndarray, State]:
    """Oil and winding after every row of sorted rows, and the state they leave; ``enters`` counts if its unit goes on."""
    unit, t = pdf["transformer_id"].to_numpy(), seconds_of(pdf["ts"])
    start = begins(unit)
    entering = np.full((start.sum(), 3), np.nan)
    if enters is not None and enters.unit == unit[0]:
        entering[0] = enters.seconds, enters.oil, enters.winding
    oil, winding = follow_units(pdf, t, start, entering)
    return oil, winding, State(unit[-1], float(t[-1]), float(oil[-1]), float(winding[-1]))


def pieces_of(measurements: DataFrame, registry: DataFrame, pieces: int | None) -> DataFrame:
    """Rows with their design, sorted over pieces of about equal size; kept in the shared folder, so pieces stay as they are."""
    from .thermal import with_design
    rows = with_design(measurements, registry).select(*COLUMNS)
    by = ["transformer_id", *ROW_ORDER]
    ranged = rows.repartitionByRange(pieces, *by) if pieces else rows.repartitionByRange(*by)
    return cut_lineage(ranged.sortWithinPartitions(*by)).withColumn("piece", F.spark_partition_id())


def _edges(rows: DataFrame) -> list:
    """(piece, first unit, last unit, last instant) in order."""
    last = F.max(F.struct("transformer_id", "ts"))
    edges = rows.groupBy("piece").agg(F.min("transformer_id").alias("first"), last.alias("last"))
    return edges.select("piece", "first", F.col("last.transformer_id").alias("last"),
                        F.unix_micros("last.ts").alias("micros")).orderBy("piece").collect()


def _entering(rows: DataFrame) -> dict[int, State]:
    """The state that enters each piece whose first unit began in an earlier piece."""
    edges = _edges(rows)
    goes_on = {b["piece"]: State(b["first"], a["micros"] / 1e6, 0.0, 0.0) for a, b in zip(edges, edges[1:]) if a["last"] == b["first"]}
    if not goes_on:
        return {}

    def run(batches):
        """What the piece's last unit has at the end, for three states at the piece's start: enough for its affine map."""
        piece, ends = None, None
        for pdf in batches:
            if len(pdf):
                if piece is None:
                    piece = int(pdf["piece"].iloc[0])
                    at = goes_on.get(piece)
                    ends = [None if at is None else State(at.unit, at.seconds, y, w) for y, w in ((0.0, 0.0), (1.0, 0.0), (0.0, 1.0))]
                ends = [model(pdf, s)[2] for s in ends]
        if piece is not None:
            yield pd.DataFrame([(piece, ends[0].unit, *(v for s in ends for v in (s.oil, s.winding)))],
                               columns=["piece", "unit", "y0", "w0", "y1", "w1", "y2", "w2"])

    maps = rows.mapInPandas(run, "piece int, unit string, y0 double, w0 double, y1 double, w1 double, y2 double, w2 double")
    entering, before = {}, None
    for m in sorted(maps.collect(), key=lambda r: r["piece"]):  # as many rows as pieces
        oil = winding = 0.0
        if m["piece"] in goes_on:
            at = goes_on[m["piece"]]
            oil, winding = before
            entering[m["piece"]] = State(at.unit, at.seconds, oil, winding)
        before = (m["y0"] + (m["y1"] - m["y0"]) * oil + (m["y2"] - m["y0"]) * winding,
                  m["w0"] + (m["w1"] - m["w0"]) * oil + (m["w2"] - m["w0"]) * winding)
    return entering


def thermal_lag(measurements: DataFrame, registry: DataFrame, pieces: int | None = None) -> DataFrame:
    """M6: one row per measurement of a registered unit with the modelled temperatures, 6 dp.

    ``pieces`` is the number of row ranges (default: the session's shuffle partitions, fewer for little data).
    """
    rows = pieces_of(measurements, registry, pieces)
    entering = _entering(rows)

    def run(batches):
        state, begun = None, False
        for pdf in batches:
            if len(pdf):
                if not begun:
                    state, begun = entering.get(int(pdf["piece"].iloc[0])), True
                oil, winding, state = model(pdf, state)
                yield pdf[["transformer_id", "ts", "ambient_temperature_c", "load_percent"]].assign(
                    model_oil_c=np.round(oil, 6), model_winding_c=np.round(winding, 6))

    return rows.mapInPandas(run, LAG_SCHEMA)


def final_states(lagged: DataFrame) -> DataFrame:
    """(transformer_id, ts, oil, winding) after each unit's last reading: where a stream goes on from a batch result."""
    return lagged.groupBy("transformer_id").agg(
        F.max_by(F.struct("ts", F.col("model_oil_c").alias("oil"), F.col("model_winding_c").alias("winding")),
                 F.struct(*ROW_ORDER)).alias("s")).select("transformer_id", "s.*")
