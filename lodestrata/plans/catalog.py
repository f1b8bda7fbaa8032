"""All registered queries."""

from lodestrata.plans import (  # noqa: F401
    aggregates, flagship, keys, lifecycle, loading, quality, relations, rowrules, staging, streams, windows,
)
from lodestrata.plans.registry import oracles, queries  # noqa: F401
