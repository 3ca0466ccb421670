"""Everything the driver sees: batch queries, streaming queries, oracles."""

from __future__ import annotations

from sensorflow.plans.catalog import QUERIES
from sensorflow.plans.oracle import ORACLE


def all_queries() -> dict:
    out = dict(QUERIES)
    from sensorflow.streaming.catalog import STREAM_QUERIES
    out.update(STREAM_QUERIES)
    return out


def all_oracles() -> dict:
    out = dict(ORACLE)
    from sensorflow.streaming.catalog import STREAM_ORACLE
    out.update(STREAM_ORACLE)
    return {k: v for k, v in out.items() if k in all_queries()}
