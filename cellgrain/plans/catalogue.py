"""All queries of the library but those of the training-data operators."""

from __future__ import annotations

from cellgrain.plans import expression, fits, labels, logs, vectors  # noqa: F401
from cellgrain.plans.registry import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
