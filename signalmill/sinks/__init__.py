"""Batch writers, views and the keyed serving copy."""
from .incremental import purge_days, refresh_days, touched_days
from .layout import raw_lookback, rewrite_z_ordered
from .serving import compact, read_latest, serve, upsert_latest
from .tables import append_if_any, purge_older_than, register_rollup_views, rewrite_clustered, write_table

__all__ = [
    "append_if_any", "compact", "purge_days", "purge_older_than", "raw_lookback", "read_latest", "refresh_days", "register_rollup_views",
    "rewrite_clustered", "rewrite_z_ordered", "serve", "touched_days", "upsert_latest", "write_table",
]
