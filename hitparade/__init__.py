"""Batch analytics for daily popularity snapshots of video catalogues, on Spark DataFrames."""
