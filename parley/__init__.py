"""Conversation-insight analytics as PySpark jobs."""
