"""marketscope: market analytics over a national company registry, on Spark.

Layout:
    sources/    registry CSV / zip / table scans and sinks, fixture views
    functions/  Column -> Column expressions (ids, lenient casts, sections)
    operators/  DataFrame -> DataFrame operators (market, enrich, similarity, ...)
    plans/      composed plans: the bronze/silver/gold run and the named queries
    streaming/  incremental (file stream) registry ingestion
"""

from marketscope.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
