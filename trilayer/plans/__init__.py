"""Layer and report pipelines, composed from sources, operators and functions."""
