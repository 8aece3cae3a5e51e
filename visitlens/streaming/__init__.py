"""Structured Streaming inputs."""
