"""A Spark-native engine for curating collections of records, images and text."""
