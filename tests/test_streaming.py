import os

from quire import TopicBatch, search
from quire.operators.index import Index
from quire.streaming.topics import TOPIC_FIELD_SCHEMA, search_topic_stream


def test_saved_index_and_topic_stream(spark, tmp_path):
    docs = spark.createDataFrame([(0, "alpha beta"), (1, "beta gamma gamma"), (2, "delta"), (3, "alpha")],
                                 "doc_id long, text string")
    path = os.path.join(tmp_path, "index")
    Index.from_documents(docs, "word").save(path)
    topics = spark.createDataFrame([(1, "0", "alpha beta"), (2, "0", "gamma"), (3, "0", "delta beta")],
                                   TOPIC_FIELD_SCHEMA)
    src = os.path.join(tmp_path, "topics")
    topics.write.parquet(src)
    # the saved index answers like the documents themselves
    tb = TopicBatch.from_table(topics, "topic_id", "text", field_col="field")
    want = sorted(tuple(r) for r in search(docs, tb, k=3).collect())
    loaded = sorted(tuple(r) for r in search(Index.load(spark, path), tb, k=3).collect())
    assert loaded == want
    stream = spark.readStream.schema(TOPIC_FIELD_SCHEMA).parquet(src)
    out = os.path.join(tmp_path, "out")
    q = search_topic_stream(stream, path, out, os.path.join(tmp_path, "ckpt"), k=3)
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.read.parquet(out).drop("epoch").collect())
    assert got == want
