"""Public-procurement analytics as Spark jobs: raw files -> clean tables -> marts."""
