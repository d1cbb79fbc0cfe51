"""Telemetry analytics on Spark: spans, logs and metrics from raw records to reports.

Every operator is a plain ``DataFrame -> DataFrame`` function. Nothing here
collects, counts or materialises data on its own, with the exception of the
sinks and the stream runner, whose purpose is to write.
"""
