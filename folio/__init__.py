"""folio: review-data curation and quality checks as Spark DataFrame jobs.

``sources``    CSV and table inputs, the test-table adapters
``functions``  column expressions (epoch, rounding, NA tokens, safe casts)
``operators``  shaping, dedupe, joins, audits, the curated dataset
``sinks``      table and CSV outputs
``plans``      composite jobs, registered queries, their oracle SQL
``streaming``  incremental CSV ingest
"""
