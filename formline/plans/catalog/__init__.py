"""Registered queries: each operator over the whole star-schema tables, with its SQL counterpart."""

from formline.plans.catalog import fields, forms, models, nested, relations  # noqa: F401  (they register)
from formline.plans.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
