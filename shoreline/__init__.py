"""shoreline — beach-weather analytics on Spark.

Hourly forecasts (temperature, rain probability, UV, sunrise/sunset) per city
arrive as keyed events.  The library keeps the latest value per key, joins the
changing tables, flags daytime and good beach hours, groups good hours per day
and merges consecutive hours into periods — as batch DataFrame plans and as
Structured Streaming queries.

Layout:
  functions/  column helpers (time parsing/formatting, tolerant reads)
  operators/  DataFrame -> DataFrame building blocks (latest, joins, rules, periods, views)
  sources/    weather tables derived from the test data, payload ingest, topics, cities
  plans/      the composed beach chain and the registered queries + SQL oracles
  streaming/  Structured Streaming versions of the chain
"""

from shoreline.session import build_session, shared_dir  # noqa: F401

__version__ = "0.1.0"
