"""stopmetrics: stop-event analytics on PySpark DataFrames."""
