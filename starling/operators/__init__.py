"""Operators: enrichment joins, keyed picks, warehouse build, checks, OLAP queries."""
