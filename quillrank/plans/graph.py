"""The stage graph: order, closure and reuse, on the driver, as it has a handful of stages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence


def problems(stages: Mapping[str, Sequence[str]]) -> list[tuple[str, str]]:
    """What is wrong with a graph: needs that are unknown, and the stages of its cycles."""
    out = [("unknown", f"{name} needs {need}") for name, needs in stages.items() for need in needs if need not in stages]
    left = {name: {n for n in needs if n in stages} for name, needs in stages.items()}
    while ready := [s for s, needs in left.items() if not needs & left.keys()]:
        for s in ready:
            del left[s]
    # a stage that only waits for a cycle isn't part of it
    while ends := [s for s in left if not any(s in needs for needs in left.values())]:
        for s in ends:
            del left[s]
    return out + ([("cycle", ", ".join(sorted(left)))] if left else [])


def topological(stages: Mapping[str, Sequence[str]]) -> list[str]:
    """Stages after what they need, otherwise in their own order; a missing stage or a cycle is an error."""
    for name, needs in stages.items():
        for need in needs:
            if need not in stages:
                raise ValueError(f"{name} needs {need}, which is unknown")
    out: list[str] = []
    while len(out) < len(stages):
        ready = next((s for s in stages if s not in out and all(n in out for n in stages[s])), None)
        if ready is None:
            raise ValueError(f"a cycle among {sorted(set(stages) - set(out))}")
        out.append(ready)
    return out


def levels(stages: Mapping[str, Sequence[str]]) -> dict[str, int]:
    out: dict[str, int] = {}
    for s in topological(stages):
        out[s] = 1 + max((out[n] for n in stages[s]), default=-1)
    return out


def dependents(stages: Mapping[str, Sequence[str]], name: str) -> list[str]:
    """What needs a stage, directly or not, in order; without itself."""
    found = {name}
    for s in topological(stages):
        if found & set(stages[s]):
            found.add(s)
    return [s for s in topological(stages) if s in found and s != name]


def reusable(manifest: Mapping, key: str) -> bool:
    return manifest.get("status") == "COMPLETED" and manifest.get("cache_key") == key
