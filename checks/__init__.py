"""Registered queries and their SQL counterparts over the driver tables."""

from importlib import import_module

MODULES = ("scans", "expressions", "projections", "joins", "aggregates", "composites")


def load_all() -> None:
    for name in MODULES:
        import_module(f"checks.{name}")
