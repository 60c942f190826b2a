"""Metadata and column-lineage analytics expressed as Spark DataFrame jobs."""
