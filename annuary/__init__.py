"""annuary: Spark-native analytics over nested biographical directory records."""
