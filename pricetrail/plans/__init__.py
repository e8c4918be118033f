"""All registered queries and their SQL."""

from . import documents, gates, history, pages, panel, prices, runs, streams, texts, usage  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
