"""Search a stream of topics, one micro-batch at a time.

Query weights depend on the whole batch (Q and qdf), so a micro-batch is
treated exactly like one topic file: it is searched as a batch against a
fixed (saved) index. Each epoch's ranking is written to its own folder
with overwrite, so a micro-batch replayed after a failure replaces its own
output instead of duplicating it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.functions import weights as W
from quire.operators.index import Index
from quire.operators.topics import TopicBatch
from quire.plans.search import search

TOPIC_FIELD_SCHEMA = "topic_id long, field string, text string"


def search_topic_stream(topics: DataFrame, index_path: str, out_dir: str, checkpoint: str,
                        k: int = W.DEFAULT_TOP_K, feedback: bool = False,
                        profile: str = "word", available_now: bool = True) -> StreamingQuery:
    """Start a streaming query: ``topics`` (streaming, ``topic_id, field,
    text``) -> per micro-batch ``search`` against the index saved at
    ``index_path`` -> Parquet under ``out_dir/epoch=<id>``."""

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        index = Index.load(spark, index_path)
        tb = TopicBatch.from_table(batch, "topic_id", "text", field_col="field", profile=profile)
        ranked = search(index, tb, k=k, feedback=feedback, profile=profile)
        ranked.withColumn("epoch", F.lit(epoch_id)).write.mode("overwrite") \
              .parquet(f"{out_dir}/epoch={epoch_id}")

    writer = topics.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
