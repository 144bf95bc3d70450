"""SparkSession settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: AQE re-plans joins from measured shuffle sizes (broadcast only when the
#: materialised side is below the threshold), coalesces small partitions and splits
#: skewed sort-merge-join partitions, also where the split costs another shuffle.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def with_settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    """The builder with the settings above; a session that exists is left alone by every query."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cohortlake") -> SparkSession:
    """Session for tests and the local benchmark (single JVM)."""
    spark = (
        with_settings(SparkSession.builder.master(f"local[{cores}]").appName(app))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
