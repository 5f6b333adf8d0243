"""docmill: Spark-native document-to-passage engine."""
