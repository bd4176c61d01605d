"""Registered queries over the test tables, each with its SQL counterpart."""

from catalog.registry import ORACLES, QUERIES  # noqa: F401
from catalog import aggregating, analysing, mutating, searching, sourcing, streams  # noqa: F401
