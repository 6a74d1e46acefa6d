"""Registered queries: each runs over whole tables of a data folder.

``registry()`` gives name -> (function, checking SQL or None).
"""

from tallybook.catalog import (  # noqa: F401
    files,
    ingest,
    kept,
    ledgers,
    reports,
    tables,
    texts,
    visits,
)
from tallybook.catalog.base import registry

__all__ = ["registry"]
