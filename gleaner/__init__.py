"""gleaner: a PySpark-native engine for news-style text collections."""
