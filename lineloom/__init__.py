"""lineloom: a Spark-native engine that turns messy files into typed, traceable tables."""
