"""vitrine: a Spark-native engine for linking, scoring and summarising public-sector records."""
