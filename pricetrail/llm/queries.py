"""Importing this module registers the queries of all operators."""

from __future__ import annotations

from . import bpe, decontam, langid, licenses, linededup, mixing, neardup, pages, pii, quality, secrets, vafile, walsh  # noqa: F401
from .common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
