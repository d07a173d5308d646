"""gridtel — power-transformer telemetry analytics on Spark.

Every operator is a function from DataFrame(s) to a DataFrame.  Nothing is
collected to the driver except bounded, explicitly checked artefacts (an
Isolation-Forest node table, a size probe before a broadcast).
"""

__all__ = ["session", "params", "schemas"]
