"""Corpusloom: a Spark-native analytics engine for language-model training corpora."""
