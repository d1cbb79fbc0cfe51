"""Batch and streaming readers."""
from .config import SourceConfig
from .csv import load_signal_csv
from .tables import read_stream, read_table

__all__ = ["SourceConfig", "load_signal_csv", "read_stream", "read_table"]
