"""Run configuration, passed in by the caller; the session is always the caller's own."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

MIB = 1 << 20


@dataclass(frozen=True)
class FlowConfig:
    """Paths and limits of one daily run."""

    source: str
    target: str
    survivors: str | None = None
    quarantine: str | None = None
    min_source_rows: int = 1
    min_result_rows: int = 10
    validate_first: bool = False

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> FlowConfig:
        """Read ``TXFLOW_SOURCE``, ``TXFLOW_TARGET`` and the optional settings."""
        missing = [k for k in ("TXFLOW_SOURCE", "TXFLOW_TARGET") if not env.get(k)]
        if missing:
            raise ValueError(f"set {', '.join(missing)}")
        return cls(
            source=env["TXFLOW_SOURCE"],
            target=env["TXFLOW_TARGET"],
            survivors=env.get("TXFLOW_SURVIVORS"),
            quarantine=env.get("TXFLOW_QUARANTINE"),
            min_source_rows=int(env.get("TXFLOW_MIN_SOURCE_ROWS", "1")),
            min_result_rows=int(env.get("TXFLOW_MIN_ROWS", "10")),
            validate_first=env.get("TXFLOW_VALIDATE_FIRST", "").lower() in ("1", "true", "yes"),
        )


def spark_settings(input_bytes: int, cores: int) -> dict[str, str]:
    """Session settings sized from the bytes read and the cores at hand.

    Shuffle partitions start at about 128 MiB of input each, never fewer than the
    cores, so that one sort fits in executor memory; AQE merges them again when the
    columns that are really shuffled are smaller.
    """
    partitions = max(cores, -(-input_bytes // (128 * MIB)))
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(128 * MIB),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MIB),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
