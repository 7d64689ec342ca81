"""Import every catalog module so that its queries are registered."""

from __future__ import annotations

from matchstats.plans import catalog, catalog_eval, catalog_features, catalog_ingest, catalog_learn  # noqa: F401


def all_queries():
    return dict(catalog.REGISTRY)
