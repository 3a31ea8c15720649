"""docketline: case-event lifecycle analytics as Spark DataFrame plans."""

__version__ = "0.1.0"
