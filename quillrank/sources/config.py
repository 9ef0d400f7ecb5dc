"""Configuration, identities and small rules that live on the driver."""

from __future__ import annotations

import copy
import hashlib
import json
import secrets
from collections.abc import Iterable, Mapping
from datetime import UTC, datetime


def overridden(base: Mapping, settings: Iterable[str]) -> dict:
    """base with settings like "a.b=value"; a value is read as JSON, or else it is text."""
    out = copy.deepcopy(dict(base))
    for setting in settings:
        path, eq, value = setting.partition("=")
        if not eq:
            raise ValueError(f"{setting!r} isn't key=value")
        *above, last = path.split(".")
        at = out
        for key in above:
            at = at.setdefault(key, {})
        try:
            at[last] = json.loads(value)
        except ValueError:
            at[last] = value
    return out


def flat(config: Mapping, above: str = "") -> dict:
    out = {}
    for key, value in config.items():
        out |= flat(value, f"{above}{key}.") if isinstance(value, Mapping) else {f"{above}{key}": value}
    return out


def dig(config: Mapping, path: str) -> object:
    """The value at a path of keys, or None."""
    at: object = config
    for key in path.split("."):
        at = at.get(key) if isinstance(at, Mapping) else None
    return at


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def cache_key(stage: str, inputs: Iterable[str], config: Mapping) -> str:
    """One key for equal work, whatever the order in which inputs and settings are named."""
    return digest(json.dumps({"stage": stage, "inputs": sorted(inputs), "config": config}, sort_keys=True, separators=(",", ":")))


def run_id(prefix: str) -> str:
    return f"{prefix}_{datetime.now(UTC):%Y%m%d_%H%M%S}_{secrets.token_hex(2)}"


def valid_ratios(ratios: Mapping[str, float]) -> bool:
    return set(ratios) == {"train", "validation", "test"} and all(r >= 0 for r in ratios.values()) and abs(sum(ratios.values()) - 1) <= 1e-6


#: A small catalog of problems: id, category, difficulty and signature.
CATALOG = (
    ("p001", "arithmetic", "easy", "def total(xs)"), ("p002", "arithmetic", "medium", "def digits(n, base)"), ("p003", "strings", "easy", "def reversed_words(text)"), ("p004", "strings", "hard", "def edit_distance(a, b)"),
    ("p005", "lists", "easy", "def without_repeats(xs)"), ("p006", "lists", "medium", "def merged(xs, ys)"), ("p007", "graphs", "hard", "def shortest_path(edges, a, b)"), ("p008", "search", "medium", "def first_at_least(xs, x)"),
    ("p009", "parsing", "hard", "def evaluated(expression)"), ("p010", "recursion", "medium", "def permutations(xs)"),
)
