"""Every named query of the engine, with the DuckDB SQL that it must equal."""

from __future__ import annotations

from . import announcements, discovery, reports
from .base import Query

QUERIES: dict[str, Query] = {**reports.BOOK.queries, **announcements.BOOK.queries, **discovery.BOOK.queries}
SQL: dict[str, str] = {**reports.BOOK.sql, **announcements.BOOK.sql, **discovery.BOOK.sql}
