"""stratalake: a bronze / silver / gold lakehouse engine written as PySpark DataFrame plans."""

__version__ = "0.1.0"
