"""lexispan: lexical passage retrieval and its evaluation as Spark jobs.

Every public function takes and returns DataFrames (or Column
expressions); the heavy work runs as native Spark expressions,
joins, aggregations and windows.
"""

from lexispan.session import get_session

__all__ = ["get_session"]
