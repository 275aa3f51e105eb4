"""All named queries."""

from __future__ import annotations

from skyledger.plans import batch, gaps, serving, streams
from skyledger.plans.batch import Query

QUERIES: dict[str, Query] = {
    **batch.QUERIES, **gaps.QUERIES, **serving.QUERIES, **streams.QUERIES,
}
