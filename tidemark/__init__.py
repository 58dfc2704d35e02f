"""Point-in-time content features and conversion labels as Spark DataFrame operators."""

__version__ = "0.1.0"
