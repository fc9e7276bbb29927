"""Registered queries over the shared tables, each with its SQL where SQL can say it."""

import importlib

MODULES = ["series", "inputs", "scalars", "joins", "scores", "models", "streams", "flows"]


def catalog():
    """(queries, sql) by name."""
    from . import base

    for name in MODULES:
        try:
            importlib.import_module(f"{__name__}.{name}")
        except ModuleNotFoundError as e:
            if e.name != f"{__name__}.{name}":
                raise
    return base.QUERIES, base.SQL
