"""txflow: transaction tables on Spark, from dirty raw rows to keyed daily totals."""

from txflow.config import FlowConfig, spark_settings
from txflow.operators.quality import QualityGateError

__all__ = ["FlowConfig", "QualityGateError", "spark_settings"]
