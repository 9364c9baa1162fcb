"""Order analytics as Spark DataFrame jobs: sources, cleaning, star schema, aggregates, marts."""
