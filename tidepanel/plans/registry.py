"""Import every query module so its ``@register`` calls run, then return the registry."""

from __future__ import annotations

import importlib

MODULES = ["q_panel", "q_checks", "q_checks_broken", "q_gap", "q_model", "q_learn", "q_extra", "q_baseline"]


def load():
    for m in MODULES:
        importlib.import_module(f"tidepanel.plans.{m}")
    from tidepanel.plans.catalog import REGISTRY

    return REGISTRY
