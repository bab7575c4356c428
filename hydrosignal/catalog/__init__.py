"""Registered queries: every operator on the given tables, with its SQL counterpart.

``load()`` imports the catalog modules; each registers its queries in ``registry``.
"""

from __future__ import annotations

from hydrosignal.catalog import registry


def load() -> registry.Registry:
    from hydrosignal.catalog import (  # noqa: F401
        columns,
        joins,
        jobs,
        modelling,
        reshaping,
        sources,
        status,
        streams,
        summaries,
        windows,
    )

    return registry.REGISTRY
