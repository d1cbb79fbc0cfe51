"""Names of the tables a deployment reads and writes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class SourceConfig:
    """Catalog, schemas and prefix; every part has a default and may come from the session."""

    catalog: str = "spark_catalog"
    schema: str = "telemetry"
    raw_catalog: str = "spark_catalog"
    raw_schema: str = "telemetry_raw"
    raw_prefix: str = "otel"
    root: str | None = None

    @classmethod
    def from_session(cls, spark: SparkSession, prefix: str = "signalmill.") -> "SourceConfig":
        found = {name: spark.conf.get(prefix + name, None) for name in cls.__dataclass_fields__}
        return cls(**{name: value for name, value in found.items() if value is not None})

    def raw(self, signal: str) -> str:
        """Table name or path of a raw signal."""
        name = f"{self.raw_prefix}_{signal}"
        return f"{self.root}/{name}" if self.root else f"{self.raw_catalog}.{self.raw_schema}.{name}"

    def table(self, name: str) -> str:
        return f"{self.root}/{name}" if self.root else f"{self.catalog}.{self.schema}.{name}"
