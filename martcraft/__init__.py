"""martcraft: monthly sales data marts as Spark DataFrame plans."""

__version__ = "0.1.0"
