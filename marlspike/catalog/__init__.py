"""Every registered query by name."""

from marlspike.catalog import companies, expressions, modelling, relations, scoring, texts
from marlspike.catalog.base import Query

MODULES = [expressions, relations, texts, companies, scoring, modelling]

QUERIES: dict[str, Query] = {}
for _module in MODULES:
    QUERIES.update(_module.QUERIES)
