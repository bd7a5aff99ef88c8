"""tidewater — a PySpark-native staging engine for landed marketing-API pages.

Raw JSON pages land as text; every step after that is a DataFrame transform:
schema-explicit flattening with null-safe coercion, keep-first dedup,
per-parent incremental loads, conformance joins, metric explode/pivot,
half-open date windows, and four load modes (keyed upsert, two-table atomic
upsert, insert-only snapshot, replace-window).

Layout:
  functions/  Column -> Column scalar rules (coercions, in-row metric sums)
  sources/    landed-page reading and the test-table adapters
  operators/  dedup, joins, incremental filters, windows, selection, loads
  plans/      entity projections, audits, pipelines, registered queries
  streaming/  the same steps driven by Structured Streaming (foreachBatch)
"""

from tidewater.session import ensure_session_defaults, get_spark

__all__ = ["ensure_session_defaults", "get_spark"]
