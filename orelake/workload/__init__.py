"""The queries of the driver contract, each beside its check in SQL."""

from orelake.workload import checks, cleaning, decisions, files, kpis, layouts, models, profiles, scores  # noqa: F401
from orelake.workload.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
