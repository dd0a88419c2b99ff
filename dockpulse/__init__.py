"""Bike-share availability analytics on Spark: Bronze lake, Silver tables, Gold marts."""
