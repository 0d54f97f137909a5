"""alinea: a Spark-native engine for aligning two large taxonomies of textual standards."""
