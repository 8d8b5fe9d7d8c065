"""Delivery-performance analytics on Spark: cleaning, checks, KPIs and a star export."""
