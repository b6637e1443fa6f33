"""Incremental cleaning of raw trip files as they arrive (Structured Streaming).

The batch jobs clean a whole input at once. ``ingest`` runs the same
operators (stage flags, funnel observation, clean projection) on each
micro-batch of new CSV files. Outputs are idempotent per batch, so a
restarted query that replays a batch rewrites that batch's output rather
than double-counting it.
"""

from meterline.streaming.ingest import funnel_totals, run_clean_stream  # noqa: F401
