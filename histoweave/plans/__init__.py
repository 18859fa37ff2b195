"""Registered queries over the given tables."""

from histoweave.plans import fields, geometry, images, kernels, relational, sources, stats, workflow
from histoweave.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "fields", "geometry", "images", "kernels", "relational", "sources", "stats", "workflow"]
