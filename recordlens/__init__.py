"""recordlens: clean, count, profile, featurise and classify records that mix typed columns with text.

Every function takes and returns Spark DataFrames (or Columns) and stays lazy unless its
docstring says that it runs a job.
"""
