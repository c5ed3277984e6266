"""Registered queries over the given tables, each beside the SQL it must agree with."""

from workloads import (  # noqa: F401
    aggregates, datasets, histories, joins, quality, scalars, sketches, sources, streams, windows,
)
from workloads.registry import ORACLES, QUERIES  # noqa: F401
