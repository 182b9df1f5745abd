"""flowmark: a PySpark-native engine for traffic probe readings and road networks."""
