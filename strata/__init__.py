"""Strata: article lakehouse and hybrid retrieval as Spark jobs."""
