"""All registered queries."""

from signpost.plans import (  # noqa: F401
    catalog_io,
    catalog_store,
    catalog_stream,
    catalog_text,
    catalog_vectors,
)
from signpost.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
