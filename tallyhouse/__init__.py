"""Retail sales marts on Spark: land daily files, check them, enrich them, total them."""
