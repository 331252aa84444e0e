"""Registered queries, grouped by input table."""

from __future__ import annotations

import importlib
import pkgutil


def load_all():
    """Import every `*_queries` module once and return the registry they fill."""
    for m in sorted(pkgutil.iter_modules(__path__), key=lambda m: m.name):
        if m.name.endswith("_queries"):
            importlib.import_module(f"{__name__}.{m.name}")
    from sitecorpus.plans import registry

    return registry
