"""Row-wise cleaning of a stream of survey rows, and counters by time window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooftop.operators import cleaning


def flagged(stream: DataFrame) -> DataFrame:
    """Physical flags of arriving rows; needs no state."""
    return cleaning.physical_flags(stream, [*cleaning.A_COLUMNS, *cleaning.B_COLUMNS])


def fault_counts(stream: DataFrame, time: str = "ts", width: str = "10 minutes", late: str = "30 minutes", column: str = "height") -> DataFrame:
    """Rows and physical faults by window; rows later than late are left out."""
    rows = flagged(stream).withWatermark(time, late)
    return rows.groupBy(F.window(time, width).alias("w")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(f"{column}_phys_bad").alias("faults"),
    ).select("w.start", "w.end", "rows", "faults")
