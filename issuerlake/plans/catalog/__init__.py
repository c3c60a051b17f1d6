"""The queries of ``__spark_entry__``, grouped by the kind of operator they exercise."""

from issuerlake.plans.catalog import (  # noqa: F401
    aggregates, columns, documents, filters, joins, market, merges, quality, readmodels, tables, windows,
)
from issuerlake.plans.catalog.base import CATALOG, Tables  # noqa: F401
