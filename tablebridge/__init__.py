"""Move, clean, resolve, merge and reconcile business tables with Spark DataFrames."""
