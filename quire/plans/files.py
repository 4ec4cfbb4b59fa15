"""From the files of a collection to a written run, in one call."""

from __future__ import annotations

import warnings

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quire.functions import weights as W
from quire.functions.text import CONCEPT_DELIMITER, Profile
from quire.operators.index import Index
from quire.plans.search import Search
from quire.sources.files import inverted_file_errors, read_file_list, read_inverted_file, read_vocab, topic_batch_from_xml
from quire.sources.sinks import write_run


def index_from_files(spark: SparkSession, file_list: str, inverted: str) -> Index:
    """The index of an inverted file, with the header counts as document
    frequencies. Postings before any header are an error; header counts that
    differ from the postings read are kept and warned about."""
    postings = read_inverted_file(spark, inverted)
    errors = {r["error"]: r["n"] for r in inverted_file_errors(postings).groupBy("error").agg(F.count(F.lit(1)).alias("n")).collect()}
    orphans = errors.pop("posting before any header", 0)
    if orphans:
        raise ValueError(f"{orphans} postings before any header in {inverted}")
    for error, n in errors.items():
        warnings.warn(f"{inverted}: {error} for {n} terms", stacklevel=2)
    return Index.from_postings(postings, read_file_list(spark, file_list).select("doc_id"))


def run_from_files(spark: SparkSession, vocab: str, file_list: str, inverted: str, topics: str, out: str,
                   k: int = W.DEFAULT_TOP_K, feedback: bool = False, profile: Profile | str = "char",
                   delimiter: str = CONCEPT_DELIMITER) -> None:
    """Rank the documents of ``file_list`` for every topic by the postings of
    ``inverted`` and write the run to ``out``."""
    batch, numbers = topic_batch_from_xml(spark, topics, profile, delimiter, read_vocab(spark, vocab))
    index = index_from_files(spark, file_list, inverted)
    ranked = Search(index, batch, profile).run(k, feedback)
    write_run(ranked, numbers, read_file_list(spark, file_list), out)
