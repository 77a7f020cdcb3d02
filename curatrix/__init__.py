"""A PySpark-native engine that curates and validates datasets of machine-generated code."""
