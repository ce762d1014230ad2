"""A PySpark-native analytics engine for maritime and land remote-sensing data."""
