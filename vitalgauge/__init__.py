"""vitalgauge: account-health and product-adoption analytics as Spark DataFrames."""

from vitalgauge.params import FIXTURE_PARAMS, Params
from vitalgauge.tables import Tables

__all__ = ["FIXTURE_PARAMS", "Params", "Tables"]
