"""roadweave: a PySpark-native engine for road mapping from vehicle surveys."""

__version__ = "0.1.0"
