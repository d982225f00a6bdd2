"""A Spark-native engine for laboratory measurements: clean, harmonise, check, release and audit."""
