"""tripmart — a Spark-native trip-analytics engine.

Taxi trips and hourly weather are landed as JSON/CSV/Parquet day files,
cleaned and typed, dictionary-encoded into surrogate-key masters, joined
into a star schema and queried.  Every operator is a ``DataFrame ->
DataFrame`` function built from ``pyspark.sql.functions`` so Catalyst can
prune, push down and pick join strategies; the layout is

* ``functions``  — column expressions (dates, text, rain class, money)
* ``sources``    — readers/writers for the landed formats and the HTML pages
* ``operators``  — cleaning, dimensions, star joins, analytics, profiling
* ``plans``      — stand-in star schema, SQL text, the query registry
* ``streaming``  — the incremental daily ETL on Structured Streaming
"""

__version__ = "0.1.0"
