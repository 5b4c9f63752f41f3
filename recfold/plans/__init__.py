"""Whole jobs, the query registry and its inputs."""
