"""Operators combined into queries and the whole session job."""
