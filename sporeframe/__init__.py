"""sporeframe: a Spark-native engine for curating biological specimen records."""
