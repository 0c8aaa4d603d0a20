"""lavra: layered (Bronze, Silver, Gold) indicator tables as Spark plans."""

__version__ = "0.1.0"
