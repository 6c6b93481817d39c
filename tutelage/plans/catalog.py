"""All registered queries."""

from __future__ import annotations

from tutelage.plans import evaluate, extract, hard, prepare, rank  # noqa: F401
from tutelage.plans.registry import ORACLE, QUERIES  # noqa: F401
