"""All registered queries."""

from __future__ import annotations

import importlib

MODULES = ("marts", "bureau", "scalars", "relational", "loads", "lifecycle")


def catalogue():
    from loanmart.queries import base

    for m in MODULES:
        importlib.import_module(f"loanmart.queries.{m}")
    return base.QUERIES, base.ORACLES
