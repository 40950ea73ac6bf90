"""The queries of this subpackage, by name, with their SQL where SQL can say it."""

from __future__ import annotations

from importlib import import_module

MODULES = ("tokenids", "pieces", "simhash", "pii", "toxicity", "paragraphs", "webpages", "decontaminate", "vectors", "secrets",
           "spelling", "tokencounts", "negatives")


def queries() -> dict:
    found = {}
    for name in MODULES:
        found |= import_module(f"filigree.llm.{name}").QUERIES
    return found


def oracle_sql() -> dict[str, str]:
    found = {}
    for name in MODULES:
        found |= getattr(import_module(f"filigree.llm.{name}"), "ORACLES", {})
    return found
