"""quarry: a Spark-native engine for metadata catalogs and text corpora."""
