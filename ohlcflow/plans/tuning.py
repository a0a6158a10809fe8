"""Session settings sized from the data volume.

Spark's defaults (200 shuffle partitions, 128 MiB scan splits) fit neither a
laptop nor a 100 TB job. ``scale_conf`` derives the settings from the input
size and the cluster shape so that scan splits and shuffle partitions stay
near ``target_partition_bytes``; AQE then coalesces small shuffle partitions
and splits skewed ones at run time.
"""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

MIB = 1 << 20


def task_memory_bytes(executor_memory_bytes: int, cores_per_executor: int,
                      memory_fraction: float = 0.6) -> int:
    """Unified (execution + storage) memory one concurrent task can use."""
    return int(executor_memory_bytes * memory_fraction / max(cores_per_executor, 1))


def scale_conf(
    input_bytes: int,
    total_cores: int,
    target_partition_bytes: int = 256 * MIB,
    shuffle_ratio: float = 0.5,
    executor_memory_bytes: int | None = None,
    cores_per_executor: int | None = None,
) -> dict[str, str]:
    """Recommended SQL settings for a job reading ``input_bytes``.

    ``shuffle_ratio``: expected shuffle volume relative to the input (the bar
    jobs shuffle only a few columns after map-side combining). With the
    executor shape given, the target partition size is capped at half of the
    memory one task can use, so a shuffle partition (sorted for a window or
    hashed for an aggregate) fits without spilling.
    """
    if executor_memory_bytes and cores_per_executor:
        per_task = task_memory_bytes(executor_memory_bytes, cores_per_executor)
        target_partition_bytes = max(16 * MIB, min(target_partition_bytes, per_task // 2))
    shuffle_bytes = max(int(input_bytes * shuffle_ratio), 1)
    parts = max(total_cores, math.ceil(shuffle_bytes / target_partition_bytes))
    # round up to a multiple of the core count so waves are full
    parts = math.ceil(parts / total_cores) * total_cores
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(min(target_partition_bytes, 512 * MIB)),
        # broadcast only what is measured small (AQE re-checks at run time)
        "spark.sql.autoBroadcastJoinThreshold": str(64 * MIB),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * MIB),
        "spark.sql.session.timeZone": "UTC",
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    for k, v in conf.items():
        spark.conf.set(k, v)
