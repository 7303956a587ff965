"""Query catalogue: each module registers its queries on import."""

import importlib
import pkgutil


def load_all() -> None:
    """Import every module of this package once."""
    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")
