"""kinweave: Spark-native entity resolution and the analytics around it."""
