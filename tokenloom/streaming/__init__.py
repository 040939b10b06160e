"""Structured Streaming jobs: process only what is new."""
