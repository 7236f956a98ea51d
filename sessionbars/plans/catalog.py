"""Import every query module so that the registry is complete."""

from sessionbars.plans import q_backtest, q_desks, q_execution, q_ml, q_sessions, q_sources, q_streaming  # noqa: F401
from sessionbars.plans.registry import MODEL_QUERIES, ORACLE, QUERIES, normalize

__all__ = ["MODEL_QUERIES", "ORACLE", "QUERIES", "normalize"]
