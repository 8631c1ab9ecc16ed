"""wardline: a Spark-native engine for auditing, harmonising and extracting person/concept event tables."""
