"""candlemill: market-bar analytics expressed as Spark DataFrame jobs.

Every public operator takes and returns DataFrames and stays lazy; only the
functions under ``plans`` and ``sources.facts`` that say so write tables.
"""

__version__ = "0.1.0"
