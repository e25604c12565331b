"""Customer-value reporting on Spark.

Rolling-horizon deposit / withdrawal / revenue metrics, running totals and
threshold-crossing dates, top product per horizon, latest balance, currency
normalisation, bonus expense and KPI ratios, assembled into two wide
per-customer reports. Every operator is a plain function from DataFrames to a
DataFrame built from built-in Spark operators (no Python UDFs).
"""

from customer360.config import ReportParams

__all__ = ["ReportParams"]
