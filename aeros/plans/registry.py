"""All registered queries: importing the modules fills the registry."""

from __future__ import annotations

from . import linear, models, records, tables
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "linear", "models", "records", "tables"]
