"""quillon: Spark-native data engineering for dirty tabular sources and text corpora."""
