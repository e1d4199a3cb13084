"""Spark-native indicator, card-spend, keyword, retrieval and forecast dataflows."""
