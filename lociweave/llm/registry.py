"""Queries of this subpackage by name."""

from __future__ import annotations

from importlib import import_module

MODULES = ["decontamination", "secrets", "tokens", "toxicity", "suffixes", "urls", "simhash", "mixing", "warc", "quality", "licenses", "alignment", "collocations"]


def entries() -> dict[str, tuple]:
    out: dict[str, tuple] = {}
    for m in MODULES:
        out.update(import_module(f"lociweave.llm.{m}").QUERIES)
    return out
