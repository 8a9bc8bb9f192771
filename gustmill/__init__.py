"""Wind-turbine telemetry on Spark: bronze, silver and gold layers, and what-if operators."""

from gustmill.plans.lake import Lake
from gustmill.plans.packed import PackedLake
from gustmill.session import build_session

__all__ = ["Lake", "PackedLake", "build_session"]
