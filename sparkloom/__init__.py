"""A PySpark-native engine for governed text-corpus analytics."""
