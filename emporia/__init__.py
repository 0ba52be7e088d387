"""emporia — an e-commerce data warehouse built as PySpark DataFrame jobs.

Layers follow the classic daily warehouse flow:

    sources   raw snapshots, change records and app logs  (ODS)
    operators dimensions (DIM), facts (DWD), summaries (DWS), reports (ADS)
    sinks     partition overwrite, report publishing
    streaming log / change-record routing with Structured Streaming
    plans     the daily chain, and the query catalog used for checking

Every operator is a plain ``DataFrame -> DataFrame`` function parameterised by
one business date ``do_date`` (``yyyy-MM-dd``); reading and writing live in
``sources`` and ``sinks`` only.
"""

from emporia.session import get_session

__all__ = ["get_session"]
