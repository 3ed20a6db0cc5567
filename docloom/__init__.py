"""docloom: a PySpark-native engine that turns technical documents into governed tables."""
