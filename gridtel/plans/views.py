"""Every layer as a named view, and the model macros as SQL functions, for plain ``spark.sql``.

Views belong to the session; they read the stored layers where these are materialized.
"""
from __future__ import annotations

from pyspark.sql import SparkSession

from .. import params as P
from ..functions.timefmt import RFC3339_PATTERN
from .layers import Layers

VIEWS = {"transformers": "registry", "events": "events", "raw_telemetry": "raw", "measurements": "measurements",
         "stg_telemetry": "stg", "int_telemetry": "int", "dim_time": "dim_time", "dim_transformer": "dim_transformer",
         "dim_location": "dim_location", "dim_sensor": "dim_sensor", "fact_transformer_measurement": "fact",
         "fact_transformer_event": "fact_event"}

_STRESS = (f"least(1D, {P.TSI_WEIGHT_WINDING}D * greatest(winding, 0D) / {P.CRITICAL_WINDING_C}D"
           f" + {P.TSI_WEIGHT_OIL}D * greatest(oil, 0D) / {P.CRITICAL_OIL_C}D"
           f" + {P.TSI_WEIGHT_LOAD}D * greatest(load, 0D) / {P.CRITICAL_LOAD_PERCENT}D)")

# name -> (parameters, type, body); the column functions of the same names are in ``functions``
FUNCTIONS = {
    "payload_field": ("payload STRING, field STRING", "STRING", "get_json_object(payload, '$.' || field)"),
    "normalize_ts": ("text STRING", "TIMESTAMP",
                     f"date_trunc('second', CASE WHEN text RLIKE r'{RFC3339_PATTERN}' THEN try_cast(text AS TIMESTAMP) END)"),
    "thermal_stress_index": ("winding DOUBLE, oil DOUBLE, load DOUBLE", "DOUBLE",
                             f"CAST(round(CAST({_STRESS} AS DECIMAL(28, 9)), 3) AS DOUBLE)"),
    "classify_state": ("winding DOUBLE, oil DOUBLE, load DOUBLE", "STRING",
                       f"CASE WHEN winding >= {P.CRITICAL_WINDING_C} OR oil >= {P.CRITICAL_OIL_C} OR load >= {P.CRITICAL_LOAD_PERCENT}"
                       f" THEN 'CRITICAL' WHEN winding >= {P.WARNING_WINDING_C} OR oil >= {P.WARNING_OIL_C} OR load > {P.OVERLOAD_PERCENT}"
                       " THEN 'WARNING' ELSE 'NORMAL' END"),
}


def create_functions(spark: SparkSession) -> None:
    for name, (parameters, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")


def create_views(layers: Layers) -> None:
    """Register all views and functions in the session of ``layers``."""
    create_functions(layers.spark)
    for name, layer in VIEWS.items():
        getattr(layers, layer).createOrReplaceTempView(name)
