"""noticeworks: a PySpark-native engine for public-notice data."""
