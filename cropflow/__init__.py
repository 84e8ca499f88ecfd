"""cropflow: Spark-native agricultural-statistics pipeline."""
