"""Registered queries with their SQL."""

from textloom.plans import counts, links, lists, markup, names, order, pages, quality, repairs, surfaces, text, validation, variants, volumes
from textloom.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "counts", "links", "lists", "markup", "names", "order", "pages", "quality", "repairs", "surfaces", "text", "validation", "variants", "volumes"]
