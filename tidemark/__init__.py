"""Warehouse modelling on Spark: staging, grain-safe marts, late data, history and checks."""
