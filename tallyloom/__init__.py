"""Batch analytics as plain DataFrame functions: text index, joins, play logs, clustering, win models."""
