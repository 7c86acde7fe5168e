"""Quayside: nested commerce events in, a retail star schema and its metrics out, on PySpark."""

__version__ = "0.1.0"
