"""Operators put together: the medallion run, full retrieval, the query catalogue."""
