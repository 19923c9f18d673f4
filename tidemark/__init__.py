"""Incremental snapshot tables on Spark: history, current state, run audit."""
