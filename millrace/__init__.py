"""millrace: user-level data operators for batch tables and streams on PySpark."""

__version__ = "0.1.0"
