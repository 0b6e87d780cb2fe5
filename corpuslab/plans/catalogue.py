"""All registered queries."""

from __future__ import annotations

from corpuslab.plans import cleaning, modelling, profile, tables, vectorising, webpages, weighting  # noqa: F401
from corpuslab.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
