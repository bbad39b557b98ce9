"""agrolith: a PySpark-native analytics engine for tabular, hierarchical and seasonal data."""
