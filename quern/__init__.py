"""Analytics for tables of events, intervals, records and texts, on PySpark."""
