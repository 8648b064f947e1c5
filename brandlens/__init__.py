"""Brand-table profiling, cleaning, enrichment models and quality gates on Spark."""
