"""voxloom: a PySpark-native engine for speech-dataset tables."""
