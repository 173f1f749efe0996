"""All queries of the library by name, with the same query in DuckDB's SQL where SQL has it."""

from __future__ import annotations

from vitrine.plans import answers, declarations, documents, edges, files, graphs, money, parsing, published, publishing, relational, resolution, rules, scalars, spreadsheets, statements, subgraphs, watchlists, webpages  # noqa: F401
from vitrine.plans.registry import ORACLE_SQL, QUERIES  # noqa: F401
