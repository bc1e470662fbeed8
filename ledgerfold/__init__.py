"""Event-sourced catalogue analytics on Spark: tables in, tables out."""

__version__ = "0.1.0"
