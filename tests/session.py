"""Local session for tests, the comparison and the bench."""

import os

from pyspark.sql import SparkSession


def make_session(cpus: str | int | None = None, partitions: int | None = None):
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("gradus")
        .config("spark.sql.shuffle.partitions", str(partitions or 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
