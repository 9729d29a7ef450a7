"""caseloom: a PySpark-native engine for evidence-backed dataset curation."""
