"""folioflow: Spark-native operators for streams of bibliographic records."""
