"""Registered queries over the driver tables, each with its SQL twin where one exists."""

from __future__ import annotations

import importlib

AREAS = ("grid", "dates", "catalog", "store", "pixels", "jobs")


def load():
    """All registered queries and their SQL twins."""
    for area in AREAS:
        importlib.import_module(f"{__name__}.{area}")
    from .base import ORACLES, QUERIES

    return QUERIES, ORACLES
