"""All registered jobs and their DuckDB oracle SQL."""

from __future__ import annotations

import importlib

_MODULES = [
    "sparkwright.plans.basic",
    "sparkwright.plans.text_jobs",
    "sparkwright.plans.shape_jobs",
    "sparkwright.plans.graph_jobs",
    "sparkwright.plans.stats_jobs",
    "sparkwright.plans.reconcile_jobs",
    "sparkwright.plans.types_jobs",
    "sparkwright.plans.model_jobs",
    "sparkwright.plans.format_jobs",
    "sparkwright.plans.io_jobs",
]


def _load():
    jobs, oracle = {}, {}
    for m in _MODULES:
        mod = importlib.import_module(m)
        for k, v in mod.JOBS.items():
            if k in jobs:
                raise ValueError(f"duplicate job {k}")
            jobs[k] = v
        oracle.update(getattr(mod, "ORACLE", {}))
    missing = set(oracle) - set(jobs)
    if missing:
        raise ValueError(f"oracle without job: {sorted(missing)}")
    return jobs, oracle


def jobs():
    return _load()[0]


def oracle():
    return _load()[1]
