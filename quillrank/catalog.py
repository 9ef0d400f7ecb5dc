"""All queries of the library and their SQL, by name."""

from __future__ import annotations

from quillrank.plans import candidates, composites, datasets, decisions, models, records, storage, validators  # noqa: F401  registers
from quillrank.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
