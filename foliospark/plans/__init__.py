"""Composed queries: enrichment, rollups, rankings, lookups, entity-schema and hybrid patterns."""
