"""loomcurate: a Spark-first engine for curating language-model training data."""
