"""Tradewind: retail and commerce analytics expressed as Spark DataFrame jobs."""
