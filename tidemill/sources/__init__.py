"""Readers of topics, change logs, rules and delimited lines."""
