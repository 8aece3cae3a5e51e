"""Batch inputs."""
