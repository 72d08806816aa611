"""Whole flows composed of operators, and their configuration."""
