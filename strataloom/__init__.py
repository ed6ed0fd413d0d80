"""Spark-native engine: typed property graphs from chunked text, and the conflicts inside them."""
