"""tarnbeck: a Spark-native document-ingestion and chunk-index engine."""
