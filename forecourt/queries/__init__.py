"""Registered queries by topic; importing this package fills the registry."""

from forecourt.queries import business, documents, dq, kpi, loading, marts  # noqa: F401
from forecourt.queries.registry import ORACLES, QUERIES  # noqa: F401
