"""A PySpark-native data-quality gate and analytics engine for event streams."""
