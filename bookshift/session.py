"""Session defaults for migration jobs.

The settings below are the ones that matter at scale:

* AQE on, with partition coalescing and skew-join splitting, so a loan or
  client key that holds a large share of the rows is split at run time
  instead of landing in one task.
* ``autoBroadcastJoinThreshold`` stays a byte bound: the planner only
  broadcasts a side whose estimated size is under it, and AQE re-checks with
  the real size after each stage.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "bookshift", extra: dict | None = None) -> SparkSession:
    """Create or reuse a session with the defaults above.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster
    leave them unset and let the submit configuration decide.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
