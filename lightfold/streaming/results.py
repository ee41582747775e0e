"""Results as a stream: message files are merged into the store as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schemas import RESULT
from ..store import Store


def follow(store: Store, folder: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Merges JSON result messages of ``folder`` into ``store``; with ``once``, those there now.

    Of several messages of a target and classifier the newest counts: that of the file changed last, then of the last file by
    name, then the last in the file.

    A batch that is repeated after a failure replaces its own rows, so every message counts once.
    """

    def merge(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            newest = Window.partitionBy("priority", "classifier").orderBy(F.desc("_at"), F.desc("_file"), F.desc("_order"))
            store.save(batch.withColumn("_order", F.monotonically_increasing_id()).withColumn("_n", F.row_number().over(newest)).where("_n = 1").select(*RESULT.names))

    messages = store.spark.readStream.schema(RESULT).json(folder).select("*", F.col("_metadata.file_modification_time").alias("_at"), F.col("_metadata.file_path").alias("_file"))
    writer = messages.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
