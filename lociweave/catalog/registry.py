"""All bindings by name."""

from __future__ import annotations

from importlib import import_module

MODULES = ["linking", "ranking", "contrasting", "screening", "curation", "priors", "profiles", "expansions", "designs", "assays"]


def entries() -> dict[str, tuple]:
    out: dict[str, tuple] = {}
    for m in MODULES:
        found = import_module(f"lociweave.catalog.{m}").QUERIES
        overlap = out.keys() & found.keys()
        if overlap:
            raise ValueError(f"registered twice: {sorted(overlap)}")
        out.update(found)
    return out
