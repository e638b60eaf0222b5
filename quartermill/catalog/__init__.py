"""Registered queries: each one with an independent SQL statement for the same answer."""

from quartermill.catalog.registry import QUERIES


def load() -> dict:
    """Import every query module and return the registry."""
    from quartermill.catalog import (  # noqa: F401
        aggregation, context, exchange, filtering, joining, products, programme, quality, reshaping, scanning, series, text, transforms,
    )

    return QUERIES
