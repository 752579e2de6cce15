"""corpuskit: text-corpus and rollout analytics as Spark jobs.

Everything takes and returns DataFrames (or Columns); planning is left to
Catalyst.  See README.md for the map from operators to modules.
"""
