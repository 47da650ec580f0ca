"""Queries over the sample tables, one module per group of operators."""

import importlib

# The modules that register queries.
MODULES = ["scans", "joining", "scalar", "texts", "paths", "geometry", "storage"]


def load_all() -> None:
    for name in MODULES:
        importlib.import_module(f"catalog.{name}")
