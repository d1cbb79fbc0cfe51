"""Datasets and how they build on each other."""
from .medallion import build, datasets
from .registry import Dataset, Registry

__all__ = ["Dataset", "Registry", "build", "datasets"]
