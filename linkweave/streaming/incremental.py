"""Incremental resolution: new S1 records as a stream against a stored pool index.

Each micro-batch is blocked like a batch query (a stream-static join) and its candidates are written
under the batch's number. A batch that runs again after a failure overwrites its own folder, so that
the result is the same as if it had run once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from linkweave.operators.token_block import Limits, TokenIndex, hybrid_block


def resolve_stream(spark: SparkSession, source: str, schema: StructType | str, pool: DataFrame | TokenIndex, out: str, checkpoint: str, block: Callable[[DataFrame, DataFrame | TokenIndex], DataFrame] | None = None, files_a_batch: int = 10) -> StreamingQuery:
    """Starts a query over new parquet files of source (entity_id, name, address, country) and stops after the present ones.

    pool: a stored index (sources.token_store.load_index), which a micro-batch only looks keys up in, or
    records, whose keys each micro-batch derives anew.
    """
    block = block or (lambda s1, p: hybrid_block(s1, p, Limits()))

    def each(batch: DataFrame, number: int) -> None:
        fresh = batch.dropDuplicates(["entity_id"]).persist()
        try:
            block(fresh, pool).write.mode("overwrite").parquet(f"{out}/batch={number}")
        finally:
            fresh.unpersist()

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(source)
    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
