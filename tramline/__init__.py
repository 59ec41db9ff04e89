"""tramline: transit and weather analytics as Spark DataFrame jobs.

Layers:
  functions/  column expressions (time, codes, rounding, text, hashing)
  sources/    feed flattening, reference CSV loading, test-data adapters
  operators/  windows, dimension joins, keyed fold/upsert, sinks, data quality
  plans/      staging models, marts, ad-hoc reports, named model catalog
  streaming/  Structured Streaming jobs over landed snapshot files
"""

from tramline.session import build_session, configure, scratch_dir

__all__ = ["build_session", "configure", "scratch_dir"]
