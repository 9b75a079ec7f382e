"""paperloom: a PySpark-native engine that turns paper collections into structured knowledge."""

__version__ = "0.1.0"
