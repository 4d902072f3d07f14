"""Sentiment, entity and topic analytics over short posts, as Spark DataFrame jobs."""
