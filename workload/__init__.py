"""The library's queries on the given tables, each with an independent SQL twin."""
