"""Structured Streaming jobs over the event table, each with a batch twin among the queries."""
