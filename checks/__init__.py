"""Registered queries and their SQL twins over the given tables."""

from __future__ import annotations

import importlib

MODULES: list[str] = [
    "slots", "sessions", "bids", "curves", "lifetime", "places", "campaigns", "files",
]


def load_all() -> None:
    for module in MODULES:
        importlib.import_module(f"checks.{module}")
