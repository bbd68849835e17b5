"""All registered queries."""

from __future__ import annotations


def _load() -> None:
    from tidecast.catalog import (  # noqa: F401
        aggregates,
        fleet,
        jobs,
        joins,
        models,
        storage,
        streams,
        timeline,
        watch,
    )


def all_queries() -> dict:
    from tidecast.catalog import base

    _load()
    return dict(base.QUERIES)


def all_oracles() -> dict:
    from tidecast.catalog import base

    _load()
    return dict(base.ORACLES)
