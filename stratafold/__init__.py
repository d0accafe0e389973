"""stratafold: a Spark-native engine for hierarchical place data."""
