"""All registered queries, by name."""

from __future__ import annotations

from tessera.plans import claims, features, ingest, logs, metrics, model_checks, models, recommend


def all_queries() -> dict:
    out: dict = {}
    for mod in (logs, ingest, claims, recommend, metrics, features, model_checks, models):
        out.update(mod.QUERIES)
    return out


def all_oracles() -> dict[str, str]:
    from tessera.plans.oracle import ORACLE
    return dict(ORACLE)
