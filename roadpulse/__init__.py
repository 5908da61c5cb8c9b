"""roadpulse: road-safety analytics on Spark tables and streams."""

__version__ = "0.1.0"
