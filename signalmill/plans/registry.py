"""A dictionary of named datasets: what each reads, and how it is written."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


ACTIONS = ("warn", "drop", "fail", "quarantine")


@dataclass(frozen=True)
class Dataset:
    """``make`` takes the DataFrames named in ``reads`` and returns the new one.

    ``expectations`` are named predicates of its rows, and ``action`` what becomes of rows that break one: warn
    keeps them, drop leaves them out, fail stops, quarantine writes them apart (``plans.checks``).
    """

    name: str
    make: Callable[..., DataFrame]
    reads: tuple[str, ...]
    kind: str = "batch"
    expectations: dict[str, str] = field(default_factory=dict)
    action: str = "warn"


@dataclass
class Registry:
    datasets: dict[str, Dataset] = field(default_factory=dict)

    def register(
        self, name: str, make: Callable[..., DataFrame], reads: tuple[str, ...], kind: str = "batch",
        expectations: dict[str, str] | None = None, action: str = "warn",
    ) -> None:
        if kind not in ("batch", "stream"):
            raise ValueError(f"unknown kind {kind!r}")
        if action not in ACTIONS:
            raise ValueError(f"unknown action {action!r}")
        if name in self.datasets:
            raise ValueError(f"dataset {name!r} is registered twice")
        self.datasets[name] = Dataset(name, make, reads, kind, expectations or {}, action)

    def frame(self, name: str, inputs: dict[str, DataFrame]) -> DataFrame:
        """The dataset as one lazy plan over ``inputs``."""
        if name in inputs:
            return inputs[name]
        entry = self.datasets[name]
        return entry.make(*[self.frame(r, inputs) for r in entry.reads])
