"""Fathomline: a Spark-native analytics engine for moving-object data and training corpora."""
