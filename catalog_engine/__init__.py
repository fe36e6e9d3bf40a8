"""catalog_engine: Spark-native analytics over release catalogues.

Item tables with multi-valued categories, community ratings, have/want
counts and prices become scored records; the package then cleans, searches,
ranks and summarises them with DataFrame, Spark ML and Structured Streaming
operators only.

Layout:
    schemas      StructTypes of the stored and incoming records
    functions/   Column expressions (scores, text, numbers, nested JSON, display)
    sources/     table readers, the release store, file sinks
    operators/   ETL, store maintenance, preparation, aggregates, rankings,
                 trends, distributions, statistics
    plans/       the registered queries, their SQL oracles, the text report
    streaming/   resumable ingest with Structured Streaming
"""

__all__ = ["schemas"]
