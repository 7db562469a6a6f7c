"""pulselake: a PySpark-native lakehouse engine for personal health and station data."""
