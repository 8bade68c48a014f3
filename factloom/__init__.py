"""A PySpark-native analytics engine for web and document evidence."""
