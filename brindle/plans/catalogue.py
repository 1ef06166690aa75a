"""All registered queries of the analytics operators, and their SQL."""

from __future__ import annotations

from . import content, customers, inout, measures, recs, reports, search, supply  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
