"""statmart: statistical observations as Spark DataFrames, from landed snapshots to marts, checks and reports."""
