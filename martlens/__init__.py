"""Marketplace product, price and review analytics written as Spark DataFrame functions."""
