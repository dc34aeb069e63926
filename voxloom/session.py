"""Session builder with the settings that the engine expects."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app: str = "voxloom", cpus: int | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Return a local session; on a cluster, submit with its own master and pass only ``conf``.

    UTC is pinned because timestamps are compared with other engines.
    """
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    settings = {
        "spark.master": f"local[{cpus}]",
        "spark.sql.shuffle.partitions": str(shuffle_partitions or cpus),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    } | conf
    spark = SparkSession.builder.appName(app).config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
