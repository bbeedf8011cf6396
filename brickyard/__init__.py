"""brickyard: Spark-native analytics for property transaction markets.

Every public operator is a function from DataFrames (plus column names and
parameters) to a DataFrame. Operators never collect, never build a session and
never use Python UDFs; the plan is declared with the DataFrame API and left to
Catalyst and AQE.

Layout
------
- ``sources``    data contract, CSV / Parquet layer I/O, dimensions, the
                 sales view projected from the star-schema test tables
- ``functions``  column expressions: cleaning rules, derived features
- ``operators``  cells (medians), trends, cohorts, rankings, dimension joins,
                 profiles
- ``plans``      jobs (ingest, summarise) and plan inspection helpers
- ``streaming``  intentionally empty (the feature set has no streaming part)
"""

__version__ = "0.1.0"
