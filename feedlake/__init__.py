"""feedlake: quality profiling and ETL for multi-source listing feeds on Spark.

Every operator maps a DataFrame to a DataFrame and carries ``source_name``,
so all sources run as one Spark plan.
"""

__version__ = "0.1.0"
