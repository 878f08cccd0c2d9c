"""tarmac — flight analytics expressed as Spark DataFrame / SQL plans.

Layout:
  sources/    file readers and writers (CSV, Parquet keyed tables), fixture adapter
  functions/  Column builders: local-time -> UTC, arrival repair, buckets, ranges
  operators/  DataFrame -> DataFrame operators: zone enrichment, keyed writes, top-k, checks
  plans/      business questions, the bulk code replacement, end-to-end jobs, query registry
  streaming/  incremental variant of the load job (same operators on a streaming DataFrame)
"""

__version__ = "0.1.0"
