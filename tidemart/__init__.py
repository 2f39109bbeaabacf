"""tidemart: a Spark-native real-time e-commerce warehouse.

Behaviour logs and database change records go in; cleaned detail tables,
joined fact tables and ten-second windowed metrics come out.  Every dataset
is a DataFrame function that runs in batch and, where Spark allows, as a
Structured Streaming query.
"""

__version__ = "0.1.0"
