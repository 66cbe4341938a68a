"""starling: a retail star-schema warehouse on Spark.

A transaction feed (batch or Structured Streaming) is typed and cleaned,
enriched with customer, product, supplier and store masters, reduced to the
last matched line per order, loaded into a star schema, and queried by ten
OLAP questions.  Everything runs as DataFrame / SQL jobs.
"""

__version__ = "0.1.0"
