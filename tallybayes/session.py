"""Session helpers.

Library code always works on the caller's SparkSession.  ``get_session`` is
for tests, the bench and scripts; ``scratch_dir`` finds the shared folder for
intermediate tables (the cluster's ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tallybayes") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TALLY_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for an intermediate table, in the cluster's shared folder.

    The cluster names that folder in ``spark.checkpoint.dir`` (or the session's
    checkpoint directory is set).  Without either, a session whose executors
    are the driver itself (master ``local[...]``, as in tests) uses the system's
    temporary folder; on a cluster this fails.  Nothing is set on the session.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[.*\])?$", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = f"file://{tempfile.gettempdir()}/tallybayes-scratch"
    return f"{base.rstrip('/')}/tallybayes/{name}-{uuid.uuid4().hex[:12]}"
