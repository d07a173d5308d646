"""Fixed values of the telemetry contract and the analytical models.

These values must equal the reference's for results to match; they are
stated plainly, in their natural order.
"""
from __future__ import annotations

# --- fixed values: operating-state thresholds (degC / percent) -------------
CRITICAL_WINDING_C = 105.0
CRITICAL_OIL_C = 100.0
CRITICAL_LOAD_PERCENT = 140.0
WARNING_WINDING_C = 95.0
WARNING_OIL_C = 90.0
OVERLOAD_PERCENT = 100.0

# --- fixed values: thermal stress index weights -----------------------------
TSI_WEIGHT_WINDING = 0.5
TSI_WEIGHT_OIL = 0.3
TSI_WEIGHT_LOAD = 0.2

# --- fixed values: telemetry contract ---------------------------------------
SCHEMA_VERSION = 1
STATES = ("NORMAL", "WARNING", "CRITICAL")
TOPIC_PREFIX = "transformers"
TOPIC_SUFFIX = "telemetry"
DEFAULT_TIMESTAMP_SKEW = "5 minutes"
WINDING_OIL_TOLERANCE_C = 0.5
# (field, low, high, low_inclusive) in the order the contract checks them;
# None = unbounded.  winding has an extra lower bound relative to oil.
RANGE_RULES = (
    ("load_percent", 0.0, 200.0),
    ("ambient_temperature_c", -20.0, 55.0),
    ("oil_temperature_c", -20.0, 150.0),
    ("winding_temperature_c", None, 200.0),
    ("oil_level_percent", 0.0, 100.0),
    ("current_a", 0.0, None),
    ("voltage_kv", None, None),
)

# --- fixed values: design registry ------------------------------------------
COOLING_TYPES = ("ONAN", "ONAF", "OFAF", "OFWF", "ODAF")
VECTOR_GROUPS = ("YNd11", "YNd1", "Ynd5", "Yy0", "Dyn1", "Dd0", "YNd5", "Yd11", "Zyn11")
REFERENCE_ID_PATTERN = r"^TR-\d{3}$"
MIN_COMMISSIONING_YEAR = 1960
MAX_IMPEDANCE_PERCENT = 40.0

# --- fixed values: cooling class -> (rated top-oil rise, winding gradient) --
COOLING_RISE = {
    "ODAF": (60.0, 12.0),
    "OFWF": (58.0, 13.0),
    "OFAF": (55.0, 15.0),
    "ONAF": (52.0, 18.0),
}
DEFAULT_COOLING_RISE = (48.0, 20.0)  # ONAN and anything else
DEFAULT_LOSS_RATIO = 8.0
OIL_TIME_CONSTANT_S = 90 * 60.0
WINDING_TIME_CONSTANT_S = 7 * 60.0
VOLTAGE_DROOP_AT_FULL_LOAD = 0.02

# --- fixed values: synthetic site dimension ----------------------------------
CITIES = ("São Paulo", "Campinas", "Jundiaí", "Salto", "Itu", "Sorocaba",
          "Piracicaba", "Americana", "Valinhos", "Indaiatuba")
REGION_BY_APPLICATION = {"generation": "Sul", "renewable": "Nordeste"}
DEFAULT_REGION = "Sudeste"
COUNTRY = "Brazil"

# --- fixed values: sensor catalog (name, type, unit, min, max) --------------
SENSORS = (
    ("load", "LOAD", "%", 0, 200),
    ("ambient", "TEMPERATURE", "°C", -20, 55),
    ("oil_temperature", "TEMPERATURE", "°C", -20, 150),
    ("winding_temperature", "TEMPERATURE", "°C", -20, 200),
    ("oil_level", "LEVEL", "%", 0, 100),
    ("current", "CURRENT", "A", 0, None),
    ("voltage", "VOLTAGE", "kV", 0, None),
)

# --- fixed values: feature vectors -------------------------------------------
DESIGN_FEATURES = (
    "rated_power_mva", "hv_voltage_kv", "lv_voltage_kv", "frequency_hz", "phase_count",
    "impedance_percent", "commissioning_year", "no_load_loss_kw", "load_loss_kw", "total_mass_t",
)
TELEMETRY_FEATURES = (
    "load_percent", "ambient_temperature_c", "oil_temperature_c",
    "winding_temperature_c", "oil_level_percent",
)

# --- fixed values: Isolation Forest defaults ---------------------------------
IFOREST_TREES = 100
IFOREST_SAMPLE = 256
IFOREST_CONTAMINATION = 0.1
IFOREST_SEED = 42

# --- fixed values: paging ------------------------------------------------------
PAGE_DEFAULT = 100
PAGE_MAX = 1000
