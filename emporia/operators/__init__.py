"""Named analyses: plain functions from DataFrames to a DataFrame.

No function here triggers a Spark action, except where noted (exact
quantile cut points are scalars computed by small distributed jobs).
"""
