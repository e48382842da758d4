"""Multi-source snapshot analytics for near-Earth objects, written as PySpark DataFrame plans."""

__version__ = "0.1.0"
