"""Registered queries on the shared tables and their SQL counterparts."""
