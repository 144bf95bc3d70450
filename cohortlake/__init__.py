"""cohortlake: one-row-per-patient datasets from keyed event tables, on Spark.

Every dataset is a function ``(input DataFrames..., as_of) -> DataFrame`` that
only declares a logical plan; Catalyst/AQE choose the physical strategy.
"""

from cohortlake.params import AsOf, with_load_date

__all__ = ["AsOf", "with_load_date"]
