"""ledgerwatch: incremental warehouse loading and card-fraud reporting on Spark.

Layout:
    sources/     file, workbook and snapshot readers, batch discovery
    operators/   incremental control, fact append, SCD2, temporal joins, fraud rules
    functions/   column-expression helpers (pure Catalyst expressions)
    plans/       test-table fixtures, registered queries, oracle SQL, batch pipeline
    streaming/   file ingestion with archiving (availableNow)
"""

from ledgerwatch.session import get_session, ship_package

__all__ = ["get_session", "ship_package"]
