"""orbitlake: Spark-native Earth-observation analytics."""
