"""Composed plans and the catalog of checked queries."""

from importlib import import_module

PARTS = ["rows", "functions", "joins", "aggregates", "windows", "scoring", "sources", "streams"]


def load_all() -> None:
    for part in PARTS:
        import_module(f"{__name__}.queries_{part}")
