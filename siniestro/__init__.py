"""siniestro: declaration analytics on Spark.

Harmonises differently shaped historical loss declarations into one table,
grades quality, consolidates duplicates by event and serves the report
queries over current and historical data, all as lazy DataFrame plans.
"""

__version__ = "0.1.0"
