"""Traces as trees: depth, path, self time and critical path of every span.

Spans are told apart by trace and span id; rows without one belong to no tree and are left out, of repeated
rows the one with the least parent, start and end counts (``dedup`` them first). A span without a parent is a
root, and so is one whose parent is not in the trace (``parent_lost``). A span whose parents lead into a cycle
has no root, depth or path and is on no critical path; its self time is as any other's.

Times are whole microseconds. A span that ends before it starts, or lacks a time, covers nothing and has no
self time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import columns as C
from ..session import written
from .forest import climb, earlier_max, mark_ancestors

KEY = ["trace_id", "span_id"]


def span_nodes(spans: DataFrame, *columns: str) -> DataFrame:
    """One row per span: trace_id, span_id, parent (blank is none), start_us, end_us, and other columns of the same row."""
    start, end = F.unix_micros("start_timestamp"), F.unix_micros("end_timestamp")
    row = F.struct(C.blank_to_null(F.col("parent_span_id")).alias("parent"), start.alias("start_us"), end.alias("end_us"), *columns)
    return spans.filter("trace_id IS NOT NULL AND span_id IS NOT NULL").groupBy(*KEY).agg(F.min(row).alias("row")).select(*KEY, "row.*")


def linked(nodes: DataFrame) -> DataFrame:
    """Nodes with up, the parent if it is in the trace, and parent_lost."""
    known = nodes.select("trace_id", F.col("span_id").alias("parent"), F.lit(True).alias("_known"))
    return nodes.join(known, ["trace_id", "parent"], "left").select(
        *KEY, *[c for c in nodes.columns if c not in KEY], F.when(F.col("_known"), F.col("parent")).alias("up"),
        (F.col("parent").isNotNull() & F.col("_known").isNull()).alias("parent_lost"),
    )


def _child_times(nodes: DataFrame) -> DataFrame:
    """Each child's time within its parent's: trace_id, parent, span_id, low, high (the parent's), begin, finish."""
    parents = nodes.select("trace_id", F.col("span_id").alias("parent"), F.col("start_us").alias("low"), F.col("end_us").alias("high"))
    both = nodes.filter("parent IS NOT NULL AND parent != span_id").join(parents, ["trace_id", "parent"])
    begin, finish = F.greatest("start_us", "low"), F.least("end_us", "high")
    valid = "start_us <= end_us AND low <= high AND start_us <= high AND end_us >= low"
    return both.filter(valid).select("trace_id", "parent", "span_id", "low", "high", begin.alias("begin"), finish.alias("finish"))


def _covered(children: DataFrame) -> DataFrame:
    """The length of the union of the children's times, per parent: each child adds what no earlier one covers."""
    # Of children that begin together only the last to finish counts.
    spans = children.groupBy("trace_id", "parent", "begin").agg(F.max("finish").alias("finish"), F.min("low").alias("low"), F.min("high").alias("high"))
    seen = earlier_max(spans, ["trace_id", "parent"], ["begin"], F.col("begin"), F.col("low"), F.col("high"), "finish", "seen")
    new = F.greatest(F.col("finish") - F.greatest(F.col("begin"), F.coalesce("seen", F.col("begin"))), F.lit(0))
    return seen.groupBy("trace_id", F.col("parent").alias("span_id")).agg(F.sum(new).alias("covered_us"))


def self_times(spans: DataFrame) -> DataFrame:
    """trace_id, span_id, duration_ms, child_ms (time in which any child ran) and self_ms (the rest)."""
    nodes = span_nodes(spans)
    return _self_times(nodes, _child_times(nodes))


def _self_times(nodes: DataFrame, children: DataFrame) -> DataFrame:
    whole = F.when(F.col("start_us") <= F.col("end_us"), F.col("end_us") - F.col("start_us"))
    covered = F.when(whole.isNotNull(), F.coalesce("covered_us", F.lit(0)))
    return nodes.join(_covered(children), KEY, "left").select(
        *KEY, (whole / 1000).alias("duration_ms"), (covered / 1000).alias("child_ms"), ((whole - covered) / 1000).alias("self_ms")
    )


def _on_chain(children: DataFrame) -> DataFrame:
    """The children that their parent waited for last, one after another: trace_id, span_id.

    From the parent's end backwards: the child that finishes last, then the one that finishes last among
    those that finished when that one began, and so on. Ties: the later start, then the greater span id.
    """
    keys = ["trace_id", "parent"]
    mark = F.struct(F.col("finish").alias("at"), F.col("begin").alias("since"), F.col("span_id").alias("who"))
    ends = children.select(*keys, "low", "high", mark.alias("spot"), F.lit(1).alias("kind"), mark.alias("ended"))
    # A child looks back from its begin, past all that ended there; one that takes no time, from its own mark.
    no_time = F.col("begin") == F.col("finish")
    look = F.struct(
        F.col("begin").alias("at"), F.when(no_time, F.col("begin")).otherwise(F.lit(2**63 - 1)).alias("since"), F.col("span_id").alias("who")
    )
    looks = children.select(*keys, "low", "high", look.alias("spot"), F.lit(0).alias("kind"), F.lit(None).cast(ends.schema["ended"].dataType).alias("ended"))
    at = F.col("spot")["at"]
    seen = earlier_max(ends.unionByName(looks), keys, ["spot", "kind"], at, F.col("low"), F.col("high"), "ended", "before")
    back = seen.filter("kind = 0").select("trace_id", "parent", F.col("spot")["who"].alias("span_id"), F.col("before")["who"].alias("up"))
    last = children.groupBy(*keys).agg(F.max(mark).alias("last")).select("trace_id", F.col("last")["who"].alias("span_id"), F.lit(True).alias("marked"))
    chains = back.join(last, ["trace_id", "span_id"], "left").select(
        F.col("trace_id").alias("group"), F.col("span_id").alias("id"), "up", F.coalesce("marked", F.lit(False)).alias("marked")
    )
    return mark_ancestors(chains).select(F.col("group").alias("trace_id"), F.col("id").alias("span_id"))


def span_tree(spans: DataFrame, with_path: bool = True) -> DataFrame:
    """trace_id, span_id, root_span_id, depth, path (span ids from the root), parent_lost and in_cycle of every span."""
    nodes = written(linked(span_nodes(spans)), "span-nodes")
    links = nodes.select(F.col("trace_id").alias("group"), F.col("span_id").alias("id"), "up", F.col("span_id").alias("item"), F.lit(True).alias("passes"))
    return _named(climb(links, with_path).drop("all_pass"), nodes.select(*KEY, "parent_lost"))


def _named(climbed: DataFrame, nodes: DataFrame) -> DataFrame:
    named = climbed.withColumnsRenamed({"group": "trace_id", "id": "span_id", "root": "root_span_id", "all_pass": "on_critical_path"})
    return nodes.join(named, KEY)


def trace_waterfall(spans: DataFrame, with_path: bool = True) -> DataFrame:
    """Every span of every trace as a viewer draws it.

    trace_id, span_id, parent_span_id, service_name, name, offset_ms (from the trace's first start), duration_ms,
    self_ms, depth, root_span_id, path, on_critical_path, parent_lost, in_cycle. Ordered by offset, depth
    and path, the rows of a trace are its waterfall. A span is on the critical path of its tree if its parent
    waited for it (``_on_chain``) and is itself on the path; roots are.
    """
    nodes = written(linked(span_nodes(spans, "service_name", "name")), "span-nodes")
    children = written(_child_times(nodes), "child-times")
    chain = _on_chain(children).withColumn("_chained", F.lit(True))
    links = nodes.join(chain, KEY, "left").select(
        F.col("trace_id").alias("group"), F.col("span_id").alias("id"), "up", F.col("span_id").alias("item"),
        (F.col("up").isNull() | F.col("_chained").isNotNull()).alias("passes"),
    )
    first = nodes.groupBy("trace_id").agg(F.min("start_us").alias("_first"))
    spread = _named(climb(links, with_path), nodes.select(*KEY, "parent", "service_name", "name", "parent_lost", "start_us"))
    times = _self_times(nodes, children)
    path = ["path"] if with_path else []
    return spread.join(times, KEY).join(first, "trace_id").select(
        *KEY, F.col("parent").alias("parent_span_id"), "service_name", "name", ((F.col("start_us") - F.col("_first")) / 1000).alias("offset_ms"),
        "duration_ms", "self_ms", "depth", "root_span_id", *path, "on_critical_path", "parent_lost", "in_cycle",
    )
