"""Operators bound to the driver's tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

import importlib
import pkgutil


def load():
    """Import every module of this package and return (queries, SQL twins)."""
    from wakeframe.suite import registry

    for module in sorted(m.name for m in pkgutil.iter_modules(__path__)):
        importlib.import_module(f"{__name__}.{module}")
    return registry.QUERIES, registry.ORACLES
