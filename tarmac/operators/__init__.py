"""DataFrame -> DataFrame operators: zone enrichment, keyed writes, derived tables,
aggregation/top-k helpers and data-quality checks."""
