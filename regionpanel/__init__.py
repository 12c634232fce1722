"""PySpark library for regional time-panel analytics."""

__version__ = "0.2.0"
