"""The library on the benchmark tables: stand-in inputs, queries and their SQL."""
