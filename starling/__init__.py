"""starling: a Spark-native retail sales-mart engine."""
