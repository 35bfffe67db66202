"""corvane: a PySpark-native entity-intelligence and data-preparation engine."""

__version__ = "0.1.0"
