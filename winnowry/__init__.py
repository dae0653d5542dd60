"""A PySpark-native engine for curating large text corpora."""
