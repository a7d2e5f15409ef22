"""Spark-native analytics for flood events, river networks, radar rainfall and stream gauges."""
