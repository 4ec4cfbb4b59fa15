"""Scores of all topics and documents, block by block (J1-J3 for a ranking).

A ranking needs the best ``k`` documents of a topic, not the matched (topic,
term, document) rows, which grow with topics x documents x terms in common.
Postings meet the terms' numbers by broadcast and become one row of arrays per
document. The topics' factors are broadcast in slices of bounded size, dealt by
topic; a task multiplies blocks of its documents with a slice and gives only
the documents that can be among its best ``k`` of a topic.

A task holds a block of at most ``CELLS`` sums. Terms that many topics and many
documents of a block have are multiplied as dense matrices, all others match by
match; every matched term of every document is summed.
"""

from __future__ import annotations

from collections.abc import Iterator
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.bounded import in_turn, n_slices, sliced_join
from quire.operators.index import TERM_KEYS
from quire.operators.written import written
from quire.sources.positional import ordered_ids

CELLS = 1 << 21         # sums of a block: topics of a slice x documents
SLICE_TOPICS = 2048     # topics of a slice, about
MATCHES = 1 << 21       # matches that are expanded at a time
DENSE_TERMS = 512       # terms that are multiplied at a time
MOST_SLICES = 8         # slices whose topics the driver holds at a time
DENSE_GAIN = 64         # a match costs as much as so many products of a dense matrix
ROUNDING = 1.1e-6       # scores are ranked at six decimals


def document_vectors(postings: DataFrame, terms: DataFrame, by: Column) -> DataFrame:
    """One row per document of ``postings`` with a term of ``terms`` (``n, t1, t2,
    term``): ``doc_id, terms, tfs, by, bys``. ``by`` divides its sums; rows of an id
    that comes again with another length carry their own in ``bys``."""
    rows = (sliced_join(postings, terms, TERM_KEYS, n_slices(terms, ["t1", "t2"]))
            .select("doc_id", F.struct("term", F.col("tf").cast("double").alias("tf"), by.cast("double").alias("by")).alias("e"), by.cast("double").alias("by")))
    whole = rows.groupBy("doc_id").agg(F.collect_list("e").alias("e"), F.min("by").alias("lo"), F.max("by").alias("by"))
    return whole.select("doc_id", F.col("e.term").alias("terms"), F.col("e.tf").alias("tfs"), "by",
                        F.when(F.col("lo") != F.col("by"), F.col("e.by")).alias("bys"))


def sliced_best(vectors: DataFrame, factors: DataFrame, n_terms: int, k: int) -> DataFrame:
    """``topic_id, doc_id, score`` of ``vectors`` for the topics of ``factors``
    (``topic_id, term, f``), which are broadcast. Besides the best ``k`` positive
    scores of every topic there are others, of documents that a task met earlier."""
    table = factors.select("topic_id", "term", "f").toArrow().combine_chunks()
    topics = table.column("topic_id").combine_chunks().dictionary_encode(null_encoding="encode")
    term = table.column("term").to_numpy().astype(np.int64)
    order = np.argsort(term, kind="stable")
    sizes = np.bincount(term, minlength=n_terms)
    ids, dense_gain, cells, most_matches, dense_terms, rounding = topics.dictionary, DENSE_GAIN, CELLS, MATCHES, DENSE_TERMS, ROUNDING
    at = np.flatnonzero(sizes)
    model = vectors.sparkSession.sparkContext.broadcast(
        (ids, at, sizes[at], topics.indices.to_numpy(zero_copy_only=False)[order].astype(np.int32), table.column("f").to_numpy()[order]))

    def expanded(local, counts, first):
        """Places in the slice of all topics of the terms ``local``, and how often each repeats."""
        n = counts[local]
        ends = np.cumsum(n)
        return np.repeat(first[local] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0), n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held_terms, counts, topic_of, f = model.value
        width, first = len(names), np.cumsum(counts) - counts
        if not width:  # no topic fell to this slice
            return
        number = np.full(n_terms, -1, np.int64)
        number[held_terms] = np.arange(len(held_terms))
        step = max(1, cells // width)
        floor = np.zeros(width)
        best_topic, best_score = np.zeros(0, np.int64), np.zeros(0)

        for batch in batches:
            lists, given = batch.column("terms"), batch.column("bys")
            lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(lengths)])
            local, tfs = number[lists.flatten().to_numpy()], batch.column("tfs").flatten().to_numpy()
            owner = np.repeat(np.arange(len(lengths)), lengths)
            divisor = batch.column("by").to_numpy()
            odd = np.flatnonzero(given.is_valid().to_numpy(zero_copy_only=False))
            for a in range(0, len(lengths), step):
                b = min(a + step, len(lengths))
                part = slice(ends[a], ends[b])
                known = local[part] >= 0
                t, d, w = local[part][known], owner[part][known] - a, tfs[part][known]
                if not len(t):
                    continue
                sums = np.zeros((b - a, width))
                heavy = np.bincount(t, minlength=len(counts)) * counts * dense_gain > sums.size
                column = np.full(len(counts), -1, np.int64)
                dense = np.flatnonzero(heavy)
                for z in range(0, len(dense), dense_terms):
                    chosen = dense[z:z + dense_terms]
                    column[:] = -1
                    column[chosen] = np.arange(len(chosen))
                    mine = column[t] >= 0
                    left = np.bincount(d[mine] * len(chosen) + column[t[mine]], w[mine], minlength=(b - a) * len(chosen)).reshape(b - a, len(chosen))
                    places, n = expanded(chosen, counts, first)
                    right = np.zeros((len(chosen), width))
                    right[np.repeat(np.arange(len(chosen)), n), topic_of[places]] = f[places]
                    sums += left @ right
                light = ~heavy[t]
                lt, ld, lw = t[light], d[light], w[light]
                share = np.cumsum(counts[lt]) // most_matches
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(share)) + 1, [len(lt)]])
                for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    if x < y:
                        places, n = expanded(lt[x:y], counts, first)
                        sums += np.bincount(np.repeat(ld[x:y] * width, n) + topic_of[places], np.repeat(lw[x:y], n) * f[places], minlength=sums.size).reshape(sums.shape)
                scores = sums / divisor[a:b, None]
                for i in odd[(odd >= a) & (odd < b)].tolist():
                    # rows of one id with several lengths: the longest that the topic matches counts
                    own = slice(ends[i], ends[i + 1])
                    held = local[own] >= 0
                    places, n = expanded(local[own][held], counts, first)
                    most = np.zeros(width)
                    np.maximum.at(most, topic_of[places], np.repeat(np.asarray(given[i].values)[held], n))
                    scores[i - a] = np.divide(sums[i - a], most, out=np.zeros(width), where=most > 0)
                wanted = (scores > 0) & (scores >= floor * (1 - 1e-9) - rounding)
                if b - a > k and wanted.sum() > 4 * k * width:
                    floor = np.maximum(floor, np.partition(scores, b - a - k, axis=0)[b - a - k])
                    wanted = (scores > 0) & (scores >= floor * (1 - 1e-9) - rounding)
                doc, topic = np.nonzero(wanted)
                if not len(doc):
                    continue
                found = scores[doc, topic]
                yield pa.RecordBatch.from_arrays([names.take(pa.array(topic)), batch.column("doc_id").take(pa.array(doc + a)), pa.array(found)],
                                                 names=["topic_id", "doc_id", "score"])
                best_topic, best_score = np.concatenate([best_topic, topic]), np.concatenate([best_score, found])
                by_score = np.lexsort((-best_score, best_topic))
                best_topic, best_score = best_topic[by_score], best_score[by_score]
                rank = np.arange(len(best_topic)) - np.searchsorted(best_topic, best_topic)
                full = rank == k - 1
                floor[best_topic[full]] = np.maximum(floor[best_topic[full]], best_score[full])
                best_topic, best_score = best_topic[rank < k], best_score[rank < k]

    return vectors.mapInArrow(run, "topic_id long, doc_id long, score double")


def best_scores(postings: DataFrame, factors: DataFrame, by: Column, k: int) -> DataFrame:
    """``topic_id, doc_id, score``: sums of f * tf over the matched terms, divided by
    the document's ``by`` (a column of ``postings``, positive). All pairs among the
    best ``k`` positive scores of a topic are there, ties included; of the others
    only some. ``factors`` are ``topic_id, n, t1, t2, f`` with ``f`` not negative."""
    factors = factors.where("f IS NOT NULL").select("topic_id", *TERM_KEYS, "f").checkpoint(eager=True)
    terms = ordered_ids(factors.select(*TERM_KEYS).distinct(), TERM_KEYS, "term").checkpoint(eager=True)
    n_terms = terms.count()
    if not n_terms:
        return factors.select("topic_id", F.lit(None).cast("long").alias("doc_id"), F.lit(0.0).alias("score")).where(F.lit(False))
    numbered = sliced_join(factors, terms, TERM_KEYS, n_slices(terms, ["t1", "t2"])).select("topic_id", "term", "f").checkpoint(eager=True)
    n = max(n_slices(numbered, []), -(-numbered.select("topic_id").distinct().count() // SLICE_TOPICS))
    vectors = document_vectors(postings, terms, by)
    if n > 1:
        vectors = written(vectors, "vectors")
    at = F.pmod(F.xxhash64("topic_id"), F.lit(n))
    return in_turn((sliced_best(vectors, numbered.where(at == i), n_terms, k) for i in range(n)), n, MOST_SLICES)
