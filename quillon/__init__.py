"""quillon: a PySpark-native engine for conversational data sets."""
