"""Analytics for fleets of field sensor towers, written for Spark.

Raw parquet tables -> typed staging tables -> a star schema of two dimensions and
six facts -> operational queries.  Every function takes DataFrames and returns a
lazy DataFrame; nothing in the library collects rows to the driver.
"""

from watchpost.functions.clock import AsOf
from watchpost.plans.star import StarSchema

__all__ = ["AsOf", "StarSchema"]
