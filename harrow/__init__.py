"""harrow: a Spark-native library for curating records and corpora."""
