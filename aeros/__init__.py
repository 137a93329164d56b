"""aeros: Spark-native analytics for environmental sensor tables."""
