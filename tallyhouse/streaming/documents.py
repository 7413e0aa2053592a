"""Document stream: changes of the indexed tables as documents, the last one per id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyhouse import schemas
from tallyhouse.operators import documents, events
from tallyhouse.sinks.batches import BatchTable
from tallyhouse.streaming import jobs

GROUP = "documents"


def documents_table(path: str) -> BatchTable:
    return BatchTable(path, schemas.DOCUMENTS, ["index", "doc_id"],
                      lambda df: documents.doc_upsert(df).select(*schemas.DOCUMENTS.fieldNames()))


def start_documents(messages: DataFrame, path: str, checkpoint: str, every: str | None = "10 seconds",
                    ledger: str | None = None) -> StreamingQuery:
    """Run the document stream.

    Each micro-batch writes the last document of every id it touched, with the time of
    writing as ``biz_dt``; :func:`read_documents` keeps the last over all batches.
    """
    def last(batch: DataFrame) -> DataFrame:
        routed = documents.doc_route(events.parse_events(batch))
        return documents.doc_upsert(routed).withColumn("biz_dt", F.current_timestamp())

    return jobs.start_table(messages, documents_table(path), last, checkpoint, every, GROUP, ledger)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """The documents as they stand."""
    return documents_table(path).read(spark)
