"""Imports every plan module so its queries register, then exposes them."""

from __future__ import annotations

import importlib

from furrow.plans.registry import ORACLE, QUERIES

PLAN_MODULES = (
    "furrow.plans.payroll",
    "furrow.plans.relational",
    "furrow.plans.views",
    "furrow.plans.cleaning",
    "furrow.plans.loads",
    "furrow.plans.sensor_streams",
    "furrow.plans.harvest",
    "furrow.plans.landing",
    "furrow.plans.agronomy",
    "furrow.plans.sales_rules",
    "furrow.plans.jobs",
    "furrow.plans.coverage",
    "furrow.plans.jobs_grow",
    "furrow.plans.jobs_field",
    "furrow.plans.jobs_inventory",
    "furrow.plans.jobs_rotation",
    "furrow.plans.jobs_events",
    "furrow.plans.jobs_people",
    "furrow.plans.jobs_packing",
    "furrow.plans.jobs_checks",
    "furrow.plans.jobs_field_tables",
    "furrow.plans.jobs_safety",
)

_loaded = False


def _load():
    global _loaded
    if not _loaded:
        for m in PLAN_MODULES:
            importlib.import_module(m)
        _loaded = True


def queries():
    _load()
    return dict(QUERIES)


def oracle_sql():
    _load()
    return dict(ORACLE)
