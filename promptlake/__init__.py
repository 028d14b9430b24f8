"""Spark jobs that turn links found in mail into a clean library of prompts."""
