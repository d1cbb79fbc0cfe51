"""Projections: attribute access, time conversion, flags, keys, sanitizers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, StructType


def res_attr(key: str) -> Column:
    """Resource attribute; NULL when the key is absent."""
    return F.col("resource.attributes")[key]


def attr(key: str, type_name: str | None = None) -> Column:
    """Record attribute. Attribute text is untrusted, so a typed read never throws."""
    value = F.col("attributes")[key]
    return value.try_cast(type_name) if type_name else value


def field(path: str) -> Column:
    """Nested struct field; NULL when any level is NULL."""
    return F.col(path)


def nanos_to_ts(nanos: Column, precision: str = "micro") -> Column:
    """Epoch nanoseconds to timestamp by integer arithmetic.

    ``precision="second"`` drops the fraction, for tables that were written
    with whole-second times.
    """
    if precision == "micro":
        return F.timestamp_micros(F.call_function("div", nanos, F.lit(1_000)))
    if precision == "second":
        return F.timestamp_seconds(F.call_function("div", nanos, F.lit(1_000_000_000)))
    raise ValueError(f"unknown precision {precision!r}")


def duration_ms(start_nanos: Column, end_nanos: Column) -> Column:
    return (end_nanos - start_nanos) / F.lit(1e6)


def ts_diff_ms(start: Column, end: Column) -> Column:
    """Milliseconds between two timestamps, exact to the microsecond."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e3)


def lag_seconds(earlier: Column, later: Column) -> Column:
    """Whole seconds between two timestamps."""
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def is_error(status_code: Column) -> Column:
    """A span without a status is not an error."""
    return F.coalesce(status_code == F.lit("ERROR"), F.lit(False))


def blank_to_null(value: Column) -> Column:
    """An empty identifier means "none", as for the parent of a root span."""
    return F.nullif(F.trim(value), F.lit(""))


def now(as_of: Column | None = None) -> Column:
    return F.current_timestamp() if as_of is None else as_of


def stamp(df: DataFrame, name: str = "ingestion_timestamp", as_of: Column | None = None) -> DataFrame:
    return df.withColumn(name, now(as_of))


def hist_mean(total: Column, count: Column) -> Column:
    """Mean of a distribution; NULL for an empty one."""
    return F.try_divide(total, count)


def log_key(observed: Column, trace_id: Column, span_id: Column, body: Column) -> Column:
    """Stable digest of a log record, whatever the session's zone; missing parts count as empty text."""
    parts = [F.unix_micros(observed).cast("string"), trace_id, span_id, body]
    return F.md5(F.concat_ws("||", *[F.coalesce(p, F.lit("")) for p in parts]))


def rps(count: Column, window: Column) -> Column:
    """Requests per second over the real length of the window."""
    return count / lag_seconds(window["start"], window["end"])


def unnest_window(df: DataFrame, window: str = "window") -> DataFrame:
    return df.withColumns(
        {"window_start": F.col(f"{window}.start"), "window_end": F.col(f"{window}.end")}
    ).drop(window)


_UNIT_MICROS = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}


def interval_micros(size: str) -> int:
    """Microseconds of an interval such as "5 minutes"."""
    number, unit = size.split()
    return int(number) * _UNIT_MICROS[unit.rstrip("s")]


def floor_to(ts: Column | str, size: str) -> Column:
    """Start of the epoch-aligned interval that holds ``ts``; equals the start of a tumbling window.

    Unlike ``window`` it repeats its argument only twice, so filters on a
    bucket of a bucket stay small when Spark moves them down to the scan.
    """
    micros = F.unix_micros(ts)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(interval_micros(size))))


def tumble(ts: Column | str, size: str) -> Column:
    """Start of the tumbling window that holds ``ts``."""
    return F.window(ts, size)["start"]


def trace_derived(df: DataFrame) -> DataFrame:
    """has_errors, total duration and service count of an assembled trace."""
    return df.withColumns(
        {
            "has_errors": F.col("error_count") > 0,
            "total_trace_duration_ms": ts_diff_ms(F.col("trace_start"), F.col("trace_end")),
            "service_count": F.size("services_involved"),
        }
    )


def last_active(first: Column, second: Column) -> Column:
    """The later of two times; a missing one is ignored."""
    return F.greatest(first, second)


def drop_after_join(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*columns)


def health_status(
    error_rate: Column,
    p95: Column | None = None,
    anomalous: Column | None = None,
    critical: float = 0.05,
    warning: float = 0.01,
    slow_ms: float = 500.0,
) -> Column:
    """critical / warning / healthy by error rate, and by latency and flag if given."""
    bad = error_rate > critical
    if anomalous is not None:
        bad = bad | F.coalesce(anomalous, F.lit(False))
    fair = error_rate > warning
    if p95 is not None:
        fair = fair | (p95 > slow_ms)
    return F.when(bad, "critical").when(fair, "warning").otherwise("healthy")


def anomaly_type(error_breach: Column, latency_breach: Column) -> Column:
    """Which threshold was crossed; errors come before latency."""
    return F.when(error_breach, "error_rate").when(latency_breach, "latency").otherwise("unknown")


def or_default(value: Column, default: str) -> Column:
    return F.coalesce(value, F.lit(default))


def resolve_trace_id() -> Column:
    """trace_id of a log: its own, else from its attributes, else from its resource."""
    return F.coalesce(*map(blank_to_null, (F.col("trace_id"), attr("trace_id"), res_attr("trace_id"))))


def sanitize_health(df: DataFrame) -> DataFrame:
    """Bring golden signals into their valid ranges.

    The rate is 0 for no requests and at most 1, negative latencies and counts
    become 0, a missing count is 0 and a missing service is "unknown".
    """
    requests, errors = F.col("request_count"), F.col("error_count")
    rate = (
        F.when(F.coalesce(requests, F.lit(0)) <= 0, 0.0)
        .when(errors > requests, 1.0)
        .otherwise(F.coalesce(F.try_divide(errors, requests), F.lit(0.0)))
    )
    return df.withColumns(
        {
            "error_rate": rate,
            "latency_p95_ms": F.greatest(F.col("latency_p95_ms"), F.lit(0.0)),
            "request_count": F.greatest(F.coalesce(requests, F.lit(0)), F.lit(0)),
            "service_name": or_default(F.col("service_name"), "unknown"),
        }
    )


def gate_by_samples(df: DataFrame, n: int = 10, count: str = "sample_count", **values: str) -> DataFrame:
    """Keep a statistic only where it rests on at least ``n`` samples.

    ``values`` maps a column to "null" or "zero", its value below the gate.
    """
    gated = {}
    for name, below in values.items():
        other = F.lit(0.0) if below == "zero" else F.lit(None)
        value = F.coalesce(F.col(name), F.lit(0.0)) if below == "zero" else F.col(name)
        gated[name] = F.when(F.col(count) >= n, value).otherwise(other)
    return df.withColumns(gated)


def _shape(value: Column, have: DataType, want: DataType) -> Column:
    """``value`` as ``want``; struct fields are matched by name, absent ones are NULL."""
    if have.simpleString() == want.simpleString():
        return value
    if isinstance(have, StructType) and isinstance(want, StructType):
        known = {f.name: f.dataType for f in have.fields}
        fields = [
            (_shape(value[f.name], known[f.name], f.dataType) if f.name in known else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(have, ArrayType) and isinstance(want, ArrayType):
        return F.transform(value, lambda x: _shape(x, have.elementType, want.elementType))
    return value.cast(want)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of ``schema``, at every level of nesting: missing ones NULL, others cast, extras dropped."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            (
                _shape(F.col(f"`{f.name}`"), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in schema.fields
        ]
    )
