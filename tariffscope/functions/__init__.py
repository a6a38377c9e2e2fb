"""Column helpers: plain Python functions from Column to Column, no Python UDFs."""
