"""Session settings for jobs of a given size."""

from __future__ import annotations

_MIB = 2**20

# A shuffle partition that an executor core sorts in memory.
_PARTITION_BYTES = 128 * _MIB


def settings(shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a job whose largest shuffle moves about so many bytes.

    Adaptive execution starts from enough partitions for that shuffle, merges the small ones
    of the others, splits skewed ones, and broadcasts a side of a join only when it has
    measured it below the threshold."""
    partitions = max(cores, -(-shuffle_bytes // _PARTITION_BYTES))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(_PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * _MIB),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * _MIB),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(256 * _MIB),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
    }
