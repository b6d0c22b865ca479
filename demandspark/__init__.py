"""Demand analytics on Spark: feature tables, smoothing, curves and least-squares studies."""
