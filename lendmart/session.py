"""Sessions for tests, checks and the local bench.

The library leaves the session's options to the cluster, but for one: ``tune``.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"


def tune(spark: SparkSession) -> SparkSession:
    """Let wide projections run with split methods.

    The cleansing and encoding projections have so many columns that whole-stage
    code puts them into one method the JIT refuses to compile (over 8000 bytes of
    bytecode), several times slower than the split methods Spark falls back to above
    this limit. A limit somebody has set is left alone.
    """
    if spark.conf.get(HUGE_METHOD) == "65535":
        spark.conf.set(HUGE_METHOD, "8000")
    return spark


def local_session(cores: int | str = 8, **options) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName("lendmart")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", os.environ.get("LENDMART_MEMORY", "8g")))
    for name, value in options.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
