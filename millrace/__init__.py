"""millrace: a Spark-native engine for refining crawled web corpora."""
