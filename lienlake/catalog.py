"""Union of all registered queries and their oracle SQL."""

from __future__ import annotations


def all_queries():
    from .plans.registry import QUERIES
    out = dict(QUERIES)
    for mod in _extra_modules():
        out.update(mod.QUERIES)
    return out


def all_oracle_sql():
    from .plans.oracle import oracle_queries
    out = oracle_queries()
    for mod in _extra_modules():
        out.update(getattr(mod, "ORACLE_SQL", {}))
    return out


def _extra_modules():
    import importlib
    mods = []
    for name in ("lienlake.plans.quality_queries", "lienlake.plans.lake_queries", "lienlake.plans.seed_queries",
                 "lienlake.streaming.stream_queries"):
        try:
            mods.append(importlib.import_module(name))
        except ModuleNotFoundError as e:
            if e.name != name:
                raise
    return mods
