"""Imports every module that registers queries."""

from bidloom.registry import checks, generated, pipeline, scans, streams  # noqa: F401
from bidloom.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
