"""Registered queries with their check SQL, grouped by subject."""

from registry import (conversations, curation, distributions, exports, generation,  # noqa: F401
                      manifests, mixing, payloads, tools)
from registry.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
