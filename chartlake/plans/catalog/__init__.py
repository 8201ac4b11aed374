"""Every registered query, next to the SQL it must agree with."""

from chartlake.plans.catalog import base

# Importing a section registers its queries.
from chartlake.plans.catalog import (  # noqa: F401  isort: skip
    tables,
    cleaning,
    relational,
    gold,
    quality,
    metrics,
    text,
    retrieval,
    streams,
)

QUERIES = base.QUERIES
ORACLES = base.ORACLES
