"""Commerce change-data lake on Spark.

Row-level change events of eight shop tables become an append log (bronze), a
cleaned history (silver), type-2 dimensions, facts, daily marts and live marts.
Every operator is a function of DataFrames and parameters: it reads no clock,
collects nothing and leaves the physical plan to Catalyst and AQE.
"""
