"""Fund look-through analytics as Spark DataFrame jobs.

Layout:
  sources/    readers, test-data adapter views, FX payload, sinks
  functions/  scalar Column builders (string, numeric, date)
  operators/  reusable DataFrame -> DataFrame operators (snapshots, FX joins,
              ranking, distribution helpers, data-quality checks)
  plans/      composite jobs: bridge, NAV + FX, exposure mart, serving,
              star schema, FX refresh
  streaming/  incremental FX payload ingestion (file source + foreachBatch)
"""

__all__ = ["config"]
