"""A Spark-first engine for curating image collections and their texts."""
