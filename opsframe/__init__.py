"""opsframe: operational data work as Spark DataFrame jobs.

Every operator takes and returns DataFrames, stays lazy, and leaves the choice
of join strategy, partition count and skew handling to Catalyst and AQE.
"""
