"""Wardlake: hospital, device and pharmacy analytics as Spark DataFrame jobs.

Layers: landing CSV -> bronze Parquet -> silver star schema -> gold marts -> views.
Every transformation is a plain function from DataFrames to a DataFrame; only
``sources`` and ``plans.jobs`` read or write anything.
"""
