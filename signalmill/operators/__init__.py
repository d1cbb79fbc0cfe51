"""Operators over spans, logs and metrics."""
