"""Load each landing file once.

A bulk load repeated over a growing folder has to skip the files it already
took. The file source's checkpoint keeps that history; the rows go through the
same casting and reject rules as the batch load. Into a ledger a micro-batch that
is repeated after a failure is stored once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from larder.schemas import TABLES, Table
from larder.sinks.ledger import Ledger, put_batch
from larder.sinks.tables import append
from larder.sources import files


def load_new_files(
    spark: SparkSession,
    folder: str,
    table: Table | str,
    target: str | Ledger,
    checkpoint: str,
    rejects: str | None = None,
    **options,
) -> StreamingQuery:
    """Store the good rows of files not seen before in ``target``, then stop.

    The table's declared format decides how files are read. ``checkpoint`` must
    be on storage all executors share. A ledger takes good and rejected rows as
    the batch named by the query's id, which the checkpoint keeps, and the number
    of the micro-batch; a repeat replaces it. Into a plain table rows are
    appended, and a micro-batch repeated after a failure appends its rows again;
    rejected rows then go to the table ``rejects`` if one is named.
    """
    table = TABLES[table] if isinstance(table, str) else table

    def store(batch: DataFrame, number: int) -> None:
        loaded = files.judged(batch, table)
        if isinstance(target, Ledger):
            query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
            name = f"{query}-{number:08d}"
            put_batch(loaded.good, target.good, name)
            put_batch(loaded.rejects, target.rejects, name)
            for written in (target.good, target.rejects):
                spark.catalog.refreshTable(written)
            return
        append(loaded.good, target)
        if rejects:
            loaded.rejects.write.mode("append").saveAsTable(rejects)
        # the batch writes in a session of its own; let the caller's see the new files
        for name in filter(None, (target, rejects)):
            spark.catalog.refreshTable(name)

    return (
        files.text_rows(spark.readStream, folder, table, **options)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
