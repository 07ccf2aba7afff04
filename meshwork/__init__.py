"""A Spark-native engine for typed knowledge graphs: upserts, scores, rankings."""
