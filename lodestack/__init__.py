"""A Spark-native engine for typed, partitioned tables."""
