"""Raw rows that tests build, and the time they start at."""

from __future__ import annotations

SEC = 1_000_000_000
# 2024-01-01 00:00:00 UTC
T0 = 1_704_067_200 * SEC


def resource(service: str | None = "api", **more):
    attributes = {k.replace("_", "."): v for k, v in more.items()}
    if service is not None:
        attributes["service.name"] = service
    return (attributes, 0)


def span(trace="t1", span_id="a", parent=None, service="api", start=0.0, ms=10.0, code="OK", **more):
    begin = T0 + round(start * SEC)
    row = {
        "trace_id": trace, "span_id": span_id, "parent_span_id": parent, "name": "op", "kind": "SERVER",
        "start_time_unix_nano": begin, "end_time_unix_nano": begin + round(ms * 1_000_000),
        "attributes": {}, "status": None if code is None else (None, code), "resource": resource(service),
    }
    return row | more


def log(trace="t1", span_id="a", body="hello", at=0.0, observed=None, **more):
    nanos = T0 + round(at * SEC)
    row = {
        "event_name": "e", "trace_id": trace, "span_id": span_id, "body": body, "time_unix_nano": nanos,
        "observed_time_unix_nano": nanos if observed is None else T0 + round(observed * SEC),
        "severity_number": "9", "attributes": {}, "resource": resource(),
    }
    return row | more


def gauge(value, at=0.0, name="m", service="api", attributes=None):
    return {
        "name": name, "metric_type": "gauge", "resource": resource(service),
        "gauge": (None, T0 + round(at * SEC), value, None, attributes or {}, None),
    }


def histogram(buckets, bounds, count=None, total=0.0, at=0.0, name="h", low=None, high=None):
    count = sum(buckets or []) if count is None else count
    return {
        "name": name, "metric_type": "histogram", "resource": resource(),
        "histogram": (
            None, T0 + round(at * SEC), count, total, buckets, bounds, None, {"k": str(at)}, None, low, high, None,
        ),
    }


def exp_histogram(scale, offset, counts, at=0.0, zero=0, negative=None, name="x"):
    return {
        "name": name, "metric_type": "exponential_histogram", "resource": resource(),
        "exponential_histogram": (
            {"k": str(at)}, None, T0 + round(at * SEC), sum(counts) + zero, 1.0, scale, zero, (offset, counts),
            negative, None, None, None, None, None, None,
        ),
    }
