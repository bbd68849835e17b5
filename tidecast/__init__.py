"""Temporal data operators for running hourly forecasts on Spark.

The package is a set of DataFrame-in, DataFrame-out functions. Only ``sources`` and
``plans`` read or write storage; everything else builds a lazy plan.
"""
