"""Disclosure statements, registries, pages and signatures as Spark DataFrames."""
