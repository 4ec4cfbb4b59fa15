"""Index build (postings, document frequency, lengths, norms) as aggregates.

Layout of the index tables (one row per non-zero entry, no maps):

* ``postings(n INT, t1, t2, doc_id BIGINT, tf BIGINT, dl BIGINT)`` - term
  counts per document. ``n`` is the gram order, ``t2`` is ``''`` (string
  terms) or ``-1`` (integer ids) for unigrams. The document length ``dl`` is
  carried on each posting so scoring never joins a per-document table.
* ``terms(n, t1, t2, df BIGINT, sum_dl BIGINT)`` - documents per term.
* ``doc_lengths(doc_id BIGINT, dl BIGINT)`` - every *listed* document, 0
  when it has no unigram posting.
* scalars ``n_docs`` (listed documents) and ``avgdl`` (total unigram count
  over all posted documents, integer-divided by ``n_docs``), kept as Spark
  scalar subqueries so they are computed inside the query plan.

When documents are tokenized here, every document also emits one *length
marker* gram (``n = 0``, empty terms). It rides through the same postings
aggregate and makes ``terms`` hold ``(0, '', '', N, total length)``, so a
search derives all corpus statistics from the one postings shuffle instead
of tokenizing the documents again. Query terms never have ``n = 0``, so the
markers never match; public accessors filter them out.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import weights as W
from quire.functions.text import Profile, profile_named
from quire.operators.bounded import lookup, n_slices, sliced_join
from quire.operators.grams import MARKER_N, summed_squares, word_postings
from quire.operators.packed import with_df
from quire.operators.written import written
from quire.sources.positional import ordered_ids

TERM_KEYS = ["n", "t1", "t2"]
HOT_TERMS = 4096  # most frequent terms, joined by broadcast
BLOCK_DOCS = 1 << 14  # listed documents, by ascending id, of a block of a saved index


def long_col(df: DataFrame, col: str, name: str):
    """``col`` as BIGINT named ``name`` - the bare column when it already is.

    (A no-op cast/alias left in one branch of a plan and simplified away in
    another is enough to stop Spark from reusing a shared exchange.)"""
    if col == name and dict(df.dtypes).get(col) == "bigint":
        return F.col(col)
    return F.col(col).cast("long").alias(name)


def document_sequences(docs: DataFrame, profile: Profile, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``(doc_id, seq, dl)``: the item sequence and unigram length per document."""
    seq = profile.sequence(F.coalesce(F.col(text_col), F.lit("")))
    return (docs.select(long_col(docs, id_col, "doc_id"), seq.alias("seq"))
                .withColumn("dl", profile.length(F.col("seq"))))


def explode_grams(seqs: DataFrame, profile: Profile, keep: list[str],
                  orders: tuple[int, ...] = (1, 2), marker: bool = False) -> DataFrame:
    """One row per gram occurrence: ``keep`` columns + ``n, t1, t2``; with
    ``marker`` each row of ``seqs`` adds one ``(0, '', '')`` gram."""
    arr = profile.grams(F.col("seq"), orders)
    if marker:
        arr = F.concat(arr, F.array(F.struct(F.lit(MARKER_N).alias("n"), F.lit("").alias("t1"),
                                             F.lit("").alias("t2"))))
    g = F.explode(arr).alias("g")
    out = seqs.select(*keep, g).select(*keep, "g.n", "g.t1", "g.t2")
    cond = profile.gram_filter(F.col("t1"), F.col("t2"))
    return out if cond is None else out.where(cond)


def counted_grams(read: DataFrame, profile: Profile, orders: tuple[int, ...] = (1, 2)) -> DataFrame:
    """``doc_id, dl, n, t1, t2, tf`` and the length markers of ``doc_id, text``, for
    characters: they repeat a lot within a text and are counted inside the row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    ordered = read.select("doc_id", profile.gram_runs(text).alias("ordered"))
    rows = (ordered.select("doc_id", (F.length("ordered") / 2).cast("long").alias("dl"), profile.run_strings(F.col("ordered"), orders).alias("runs"))
                   .select("doc_id", "dl", F.explode_outer(F.concat("runs", F.array(F.lit("")))).alias("run")))
    n, t1, t2, tf = profile.run_gram(F.col("run"))
    marker = F.col("run") == ""
    return rows.select("doc_id", "dl", F.when(marker, MARKER_N).otherwise(n).alias("n"), t1, F.when(marker, "").otherwise(t2).alias("t2"),
                       F.when(marker, F.lit(1).cast("long")).otherwise(tf).alias("tf"))


def row_postings(read: DataFrame, profile: Profile, orders: tuple[int, ...] = (1, 2), keep: DataFrame | None = None, hashed: bool = False) -> DataFrame:
    """Postings and length markers of ``doc_id, text``, one row per gram and row
    of ``read``: all grams are counted inside the row, none is shuffled. ``keep``
    and ``hashed`` (for words only) as in :func:`word_postings`."""
    if profile.has_blanks():
        return counted_grams(read, profile, orders).select(*TERM_KEYS, "doc_id", "dl", "tf")
    return word_postings(read, orders, keep, hashed)


def document_postings(read: DataFrame, profile: Profile, orders: tuple[int, ...] = (1, 2), keep: DataFrame | None = None, hashed: bool = False) -> DataFrame:
    """Postings and length markers of ``doc_id, text``. A document whose id comes
    once has them from its own row; only the rows of ids that come again are
    added up by an aggregate."""
    again = read.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias("_again"), F.lit(True).alias("_twice"))
    slices = n_slices(again, [])
    if again.isEmpty():
        return row_postings(read, profile, orders, keep, hashed)
    marked = read.join(F.broadcast(again) if slices == 1 else again, read["doc_id"].eqNullSafe(F.col("_again")), "left").select("doc_id", "text", "_twice")
    once = row_postings(marked.where("_twice is null").select("doc_id", "text"), profile, orders, keep, hashed)
    twice = row_postings(marked.where("_twice").select("doc_id", "text"), profile, orders, keep, hashed)
    return once.unionByName(postings_from_grams(twice, ["n", "a", "b"] if hashed else TERM_KEYS))


def postings_from_grams(grams: DataFrame, keys: list[str] = TERM_KEYS) -> DataFrame:
    """tf per (term, document): partial + final hash aggregate (A1, A2)."""
    return (grams.groupBy("doc_id", "dl", *keys)
                 .agg(F.sum("tf").alias("tf")).select(*keys, "doc_id", "dl", "tf"))


def vocab_postings(docs: DataFrame, vocab: DataFrame, profile: Profile | str = "word", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings ``n, t1, t2, doc_id, tf`` of vocabulary ids (T6-T8 over a
    collection); ``vocab(term, term_id)``, ids of 0 or less unknown.

    Grams are formed and counted where the texts are read, so neighbours are
    neighbours in the text and a gram with an unknown word finds no partner:
    what meets the vocabulary is one row per document and distinct gram, never
    a token. The ids come to the grams by broadcast slices (see
    ``bounded.lookup``), so the grams do not move."""
    counted = Index.from_documents(docs, profile, (1, 2), id_col, text_col).materialized().postings.select(*TERM_KEYS, "doc_id", "tf")
    terms = written(vocab.select("term", F.col("term_id").cast("int").alias("term_id")).where("term_id > 0"), "vocabulary")
    single = terms.groupBy("term").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()

    def known(grams: DataFrame, column: str) -> DataFrame:
        if not single:  # a term of several ids has all of them
            marked = grams.join(terms.withColumnRenamed("term", column), column)
        else:
            marked = lookup(grams, terms.select(F.col("term").alias(column), "term_id"), column, "term_id", [column]).where("term_id IS NOT NULL")
        return marked.drop(column).withColumnRenamed("term_id", column)

    unigrams = known(counted.where("n = 1").drop("t2"), "t1").withColumn("t2", F.lit(-1))
    bigrams = known(known(counted.where("n = 2"), "t1"), "t2")
    return unigrams.unionByName(bigrams).select(*TERM_KEYS, "doc_id", "tf")


def doc_freq(postings: DataFrame) -> DataFrame:
    """Documents per term (A3), with the term's collection frequency ``cf``
    and the summed length of its documents ``sum_dl`` (for the length
    marker: the collection's total length).

    df counts the documents with ``tf > 0``, as the model defines it. Every
    statistic reads ``tf`` on purpose: column pruning then leaves the
    postings aggregate identical for the match join, the df table and the
    total-length subquery, and Spark shares one postings exchange between
    all of them instead of tokenizing the documents again for each."""
    has = F.col("tf") > 0
    return postings.groupBy(*TERM_KEYS).agg(F.count(F.when(has, F.lit(1))).alias("df"),
                                            F.sum("tf").cast("long").alias("cf"),
                                            F.sum(F.when(has, F.col("dl"))).cast("long").alias("sum_dl"))


def _posted() -> Column:
    """Counts the postings with ``tf > 0``."""
    return F.count(F.when(F.col("tf") > 0, F.lit(1)))


def lengths_from_postings(postings: DataFrame) -> DataFrame:
    """Sum of unigram tf per posted document (A4, read-postings path)."""
    return (postings.where(F.col("n") == 1).groupBy("doc_id")
                    .agg(F.sum("tf").cast("long").alias("dl")))


@dataclass
class Index:
    """Postings plus what scoring needs about the collection.

    ``postings_all`` / ``terms_all`` may hold the length markers; the
    public ``postings`` / ``terms`` / ``doc_lengths`` never do.
    """

    postings_all: DataFrame
    listed: DataFrame
    profile: Profile | None = None
    listed_only: bool = True
    markers: bool = True
    stats: tuple[int, int] | None = None  # (n_docs, total_length) when known
    _terms_all: DataFrame | None = field(default=None, repr=False)
    lengths: DataFrame | None = field(default=None, repr=False)  # doc_id, dl straight from the texts
    part: bool = False  # holds the postings of some terms only
    blocks: DataFrame | None = field(default=None, repr=False)  # n, t1, t2, block, top: of a saved index
    given_df: bool = False  # df comes with the index instead of being counted from its postings
    texts: DataFrame | None = field(default=None, repr=False)  # doc_id, text of an index built from whole documents
    orders: tuple[int, ...] = (1, 2)

    # ---- construction -------------------------------------------------
    @classmethod
    def from_documents(cls, docs: DataFrame, profile: Profile | str = "word",
                       orders: tuple[int, ...] = (1, 2), id_col: str = "doc_id",
                       text_col: str = "text", restrict_to: DataFrame | None = None) -> "Index":
        """Tokenize ``docs`` (one pass) and aggregate postings.

        Texts are tokenized where they are read and their grams counted
        inside the row, so nothing is shuffled (rows of a repeated id meet in
        an aggregate). ``restrict_to`` (``n, t1, t2`` rows) keeps only grams
        of those terms and the length markers - a search needs nothing else -
        and drops the others before they become rows (characters: before a
        partial aggregate counts them). Terms beyond one broadcast slice are
        looked up slice by slice among the counted rows.
        """
        profile = profile_named(profile)
        listed = docs.select(long_col(docs, id_col, "doc_id"))
        read = docs.select(long_col(docs, id_col, "doc_id"), F.col(text_col).alias("text"))
        lengths = document_sequences(read, profile).select("doc_id", "dl")
        if restrict_to is None:
            return cls(document_postings(read, profile, orders), listed, profile, True, True, lengths=lengths, texts=read, orders=tuple(orders))
        spark = docs.sparkSession
        marker = spark.range(1).select(F.lit(MARKER_N).alias("n"), F.lit("").alias("t1"), F.lit("").alias("t2"))
        keep = restrict_to.select(*TERM_KEYS).unionByName(marker).distinct()
        n = n_slices(keep, ["t1", "t2"])
        if n > 1:  # counted once for all slices
            counted = document_postings(read, profile, orders) if not profile.has_blanks() else postings_from_grams(counted_grams(read, profile, orders))
            postings = sliced_join(written(counted, "grams"), keep.checkpoint(eager=True), TERM_KEYS, n)
        elif not profile.has_blanks():
            postings = document_postings(read, profile, orders, keep)
        else:
            postings = postings_from_grams(counted_grams(read, profile, orders).join(F.broadcast(keep), TERM_KEYS))
        if n > 1 or not profile.has_blanks():
            postings = postings.repartition("doc_id")  # the grams of the terms, from as many tasks as the texts had, meet by document
        return cls(postings, listed, profile, True, True, lengths=lengths)

    @classmethod
    def from_postings(cls, postings: DataFrame, listed_docs: DataFrame) -> "Index":
        """An index from read postings ``(n, t1, t2, doc_id, tf)`` and the
        listed documents ``(doc_id)``. Postings of unlisted documents count
        in df and in the average length but are never ranked."""
        posted = lengths_from_postings(postings)
        terms = None
        if "df" in postings.columns:
            # the header's count is the model's df, whatever was read for it
            terms = postings.groupBy(*TERM_KEYS).agg(F.max("df").cast("long").alias("df"), F.sum("tf").cast("long").alias("cf"),
                                                     F.lit(None).cast("long").alias("sum_dl"))
        with_dl = (postings.join(posted, "doc_id", "left")
                   .select(*TERM_KEYS, F.col("doc_id").cast("long"), F.col("tf").cast("long"),
                           F.coalesce("dl", F.lit(0)).cast("long").alias("dl")))
        listed = listed_docs.select(F.col("doc_id").cast("long"))
        return cls(with_dl, listed, None, False, False, None, terms, given_df=terms is not None)

    # ---- persisted form ------------------------------------------------
    def save(self, path: str, mode: str = "errorifexists") -> None:
        """Write postings (partitioned by gram order, range-clustered by term so
        Parquet row-group statistics prune term lookups; the ``HOT_TERMS`` most
        frequent unigrams also by block, so that they spread over files), the terms, the corpus scalars and the listed
        documents.

        Listed documents are numbered by id and cut into blocks of
        ``BLOCK_DOCS``. Postings carry their term's df and their document's
        block, so weights of a saved index need no join; ``blocks`` holds the
        largest tf / norm^2 per term and block, which bounds what a block can
        score (see ``plans.search``)."""
        index = self.materialized()
        spark = index.postings_all.sparkSession
        n_docs, total = index.collect_stats()
        placed = ordered_ids(index.listed.select("doc_id").distinct(), ["doc_id"], "slot")
        placed.select("doc_id", F.expr(f"slot div {BLOCK_DOCS}").alias("block")).write.mode(mode).parquet(f"{path}/listed")
        hot, cold = index.split_by_df()
        block_of = spark.read.parquet(f"{path}/listed")
        order = [*TERM_KEYS, "block", "doc_id"]
        norm = W.length_norm(F.col("dl"), F.lit(total // n_docs if n_docs else 0))
        share = F.coalesce(F.try_divide(F.col("tf").cast("double"), norm * norm), F.lit(0.0))
        has = F.col("tf") > 0
        of_term, of_block = Window.partitionBy(*TERM_KEYS), Window.partitionBy(*TERM_KEYS, "block")
        sums = {"cf": F.sum("tf"), "sum_dl": F.sum(F.when(has, F.col("dl")))}
        # a cold term's postings meet in one range: its df, sums and block bounds are counted there, in the one sorted order
        ranged = lookup(cold, block_of, "doc_id", "block", []).repartitionByRange(*TERM_KEYS).sortWithinPartitions(*order)
        if not index.given_df:
            ranged = ranged.withColumn("df", F.count(F.when(has, F.lit(1))).over(of_term))
        for name, total_of in sums.items():
            ranged = ranged.withColumn(name, total_of.over(of_term).cast("long"))
        ranged = (ranged.withColumn("top", F.max(share).over(of_block))
                        .withColumn("term_row", F.row_number().over(of_term.orderBy("block", "doc_id")) == 1)
                        .withColumn("block_row", F.row_number().over(of_block.orderBy("doc_id")) == 1))
        cold = written(ranged, "ranged")
        hot = written(lookup(hot, block_of, "doc_id", "block", []).repartitionByRange(*order).sortWithinPartitions(*order), "frequent")
        columns = [*TERM_KEYS, "doc_id", "tf", "dl", "df", "block"]
        terms = index.terms if index.given_df else cold.where("term_row").select(*TERM_KEYS, "df", "cf", "sum_dl").unionByName(
            hot.groupBy(*TERM_KEYS).agg(F.max("df").alias("df"), *[total_of.cast("long").alias(name) for name, total_of in sums.items()]))
        blocks = cold.where("block_row AND block IS NOT NULL").select(*TERM_KEYS, "block", "top").unionByName(
            hot.where("block IS NOT NULL").groupBy(*TERM_KEYS, "block").agg(F.max(share).alias("top")))
        for name, rows in (("terms", terms), ("postings", cold.select(columns).unionByName(hot.select(columns))), ("blocks", blocks)):
            rows.write.mode(mode).partitionBy("n").parquet(f"{path}/{name}")
        spark.createDataFrame(
            [(self.listed_only, self.profile.name if self.profile else None, n_docs, total)],
            "listed_only boolean, profile string, n_docs long, total_length long",
        ).write.mode(mode).parquet(f"{path}/meta")

    def collect_stats(self) -> tuple[int, int]:
        if self.stats is not None:
            return self.stats
        spark = self.postings_all.sparkSession
        row = spark.range(1).select(self.n_docs().alias("a"), self.total_length().alias("b")).first()
        return int(row["a"]), int(row["b"] or 0)

    @classmethod
    def load(cls, spark, path: str) -> "Index":
        meta = spark.read.parquet(f"{path}/meta").first()
        postings = spark.read.parquet(f"{path}/postings").select(*TERM_KEYS, "doc_id", "tf", "dl", "df", "block")
        terms = spark.read.parquet(f"{path}/terms").select(*TERM_KEYS, "df", "cf", "sum_dl")
        prof = profile_named(meta["profile"]) if meta["profile"] else None
        return cls(postings, spark.read.parquet(f"{path}/listed").select("doc_id"), prof, bool(meta["listed_only"]),
                   False, (int(meta["n_docs"]), int(meta["total_length"])), terms,
                   blocks=spark.read.parquet(f"{path}/blocks").select(*TERM_KEYS, "block", "top"), given_df=True)

    def materialized(self) -> "Index":
        """Write the postings once as compressed Parquet to the session's
        checkpoint folder and read them from there (lineage cut; survives lost
        executors).

        Everything derived from them - df, the total length, the match
        join of both feedback passes - then reads those files instead of
        tokenizing the documents again."""
        postings = written(self.postings_all, "postings")
        return replace(self, postings_all=postings, _terms_all=self._terms_all if self.given_df else None)

    # ---- tables ---------------------------------------------------------
    @property
    def terms_all(self) -> DataFrame:
        if self._terms_all is None:
            self._terms_all = doc_freq(self.postings_all)
        return self._terms_all

    @property
    def postings(self) -> DataFrame:
        p = self.postings_all
        return p.where(F.col("n") > 0) if self.markers else p

    @property
    def terms(self) -> DataFrame:
        t = self.terms_all
        return (t.where(F.col("n") > 0) if self.markers else t).select(*TERM_KEYS, "df", "cf", "sum_dl")

    @property
    def doc_lengths(self) -> DataFrame:
        """Every listed document with its length (0 without unigrams)."""
        if self.part:
            raise ValueError("an index restricted to some terms does not know document lengths")
        if self.lengths is not None:
            return self.lengths
        if self.markers:
            return self.postings_all.where(F.col("n") == MARKER_N).select("doc_id", "dl")
        posted = lengths_from_postings(self.postings)
        return (self.listed.join(posted, "doc_id", "left")
                    .select("doc_id", F.coalesce("dl", F.lit(0)).cast("long").alias("dl")))

    # ---- scalars ---------------------------------------------------------
    def n_docs(self) -> Column:
        """Listed documents."""
        if self.stats is not None:
            return F.lit(self.stats[0]).cast("long")
        return self.listed.select(F.count(F.lit(1))).scalar()

    def total_length(self) -> Column:
        """Unigram count over all posted documents."""
        if self.stats is not None:
            return F.lit(self.stats[1]).cast("long")
        if self.markers:
            return self.postings_all.where(F.col("n") == MARKER_N).select(F.sum("dl").cast("long")).scalar()
        return self.postings_all.select(
            F.sum(F.when(F.col("n") == 1, F.col("tf"))).cast("long")).scalar()

    def avgdl(self) -> Column:
        """Total length div listed documents (A5, integer division)."""
        n = self.n_docs()
        return F.when(n > 0, W.integer_div(F.coalesce(self.total_length(), F.lit(0)), n)).cast("long")

    def corpus(self) -> DataFrame:
        """One row: ``n_docs`` (A6), ``total_length`` and ``avgdl`` (A5)."""
        if self.markers or self.lengths is not None:
            base = self.doc_lengths.agg(F.count(F.lit(1)).alias("n_docs"),
                                        F.coalesce(F.sum("dl"), F.lit(0)).cast("long").alias("total_length"))
        else:
            base = self.listed.agg(F.count(F.lit(1)).alias("n_docs")).select(
                "n_docs", F.coalesce(self.total_length(), F.lit(0)).alias("total_length"))
        avg = F.when(F.col("n_docs") > 0,
                     W.integer_div(F.col("total_length"), F.col("n_docs"))).cast("long")
        return base.withColumn("avgdl", avg)

    def restricted(self, terms: DataFrame) -> "Index":
        """Postings and df of the given terms only (left-semi against broadcast
        slices), written once; corpus scalars are fixed first so they still
        cover everything."""
        keep = terms.select(*TERM_KEYS).distinct()
        n = n_slices(keep, ["t1", "t2"])
        stats = self.stats
        if stats is None:
            stats = self.collect_stats()
        postings = sliced_join(self.postings_all.select(*TERM_KEYS, "doc_id", "tf", "dl"), keep, TERM_KEYS, n, "left_semi")
        df = sliced_join(self.terms_all, keep, TERM_KEYS, n, "left_semi")
        if not self.listed_only:
            # postings of unlisted documents count in df and in the average
            # length (both fixed above) but are never ranked; the document
            # list has no size bound, so this semi join is left to a shuffle
            postings = postings.join(self.listed, "doc_id", "left_semi")
        return Index(postings, self.listed, self.profile, self.listed_only, False, stats, df, part=True, given_df=True).materialized()

    def postings_with_df(self) -> DataFrame:
        """Postings with their term's ``df``. The ``HOT_TERMS`` most frequent
        unigrams are broadcast with theirs; the other postings move once, by
        term, in packed blocks (``packed.with_df``) and are counted there, so they
        meet no table of all terms. A df that came with the index is joined instead."""
        if self.blocks is not None:
            return self.postings.drop("block")
        hot, cold = self.split_by_df()
        if not self.given_df:
            cold = with_df(cold, TERM_KEYS)
        return hot.unionByName(cold)

    def weighed_postings(self) -> DataFrame:
        """``n, doc_id, tf, df`` of the postings, without their terms: what
        moves is two hashes of a term, 128 bits, in place of its words."""
        if self.blocks is not None or self.given_df:
            return self.postings_with_df().select("n", "doc_id", "tf", "df")
        hot, cold = self.split_by_df()
        cold = cold.select("n", "doc_id", "tf", F.xxhash64(*TERM_KEYS).alias("_a"), F.xxhash64(F.lit(1), *TERM_KEYS).alias("_b"))
        cold = cold.withColumn("df", _posted().over(Window.partitionBy("_a", "_b")))
        return hot.select("n", "doc_id", "tf", "df").unionByName(cold.select("n", "doc_id", "tf", "df"))

    def split_by_df(self) -> tuple[DataFrame, DataFrame]:
        """The postings of the ``HOT_TERMS`` most frequent unigrams with their
        ``df``, found by broadcast, and the others. Those have a ``df`` only if it
        came with the index (then the most frequent terms of both orders are
        broadcast)."""
        if self.given_df:
            terms = self.terms.select(*TERM_KEYS, "df")
        else:
            terms = self.postings.where("n = 1").groupBy(*TERM_KEYS).agg(F.count(F.when(F.col("tf") > 0, F.lit(1))).alias("df"))
        hot = F.broadcast(terms.orderBy(F.col("df").desc(), *TERM_KEYS).limit(HOT_TERMS))
        postings = self.postings.drop("df", "block")
        marked = postings.join(hot.withColumnRenamed("df", "_df"), TERM_KEYS, "left")
        cold = marked.where(F.col("_df").isNull()).drop("_df")
        return marked.where(F.col("_df").isNotNull()).withColumnRenamed("_df", "df"), cold.join(terms, TERM_KEYS) if self.given_df else cold

    # ---- per-document vectors -----------------------------------------
    def doc_norms(self, truncated: bool = True) -> DataFrame:
        """L2 norm of each listed document's tf-idf vector per gram order
        (A11): ``doc_id, n, l2``; 0 for documents without terms.

        Words are counted from the texts, whose grams move as hashes and are never
        written; other indexes read their postings."""
        if self.texts is not None and not self.profile.has_blanks():
            size = self.texts.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
            hashed = document_postings(self.texts, self.profile, self.orders, hashed=True)
            sums = summed_squares(hashed, size[1], truncated, (size[0] or 0) * len(self.orders))
        else:
            n_docs = self.n_docs()
            w = W.idf_truncated(n_docs, F.col("df")) if truncated else W.idf(n_docs, F.col("df"))
            sums = (self.weighed_postings().select("doc_id", "n", F.pow(W.tfidf(F.col("tf"), w), 2).alias("sq"))
                    .groupBy("doc_id", "n").agg(F.sum("sq").alias("sq")))
        sq = sums.select("doc_id", "n", F.sqrt("sq").alias("l2"))
        grid = self.listed.select("doc_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("n"))
        return (grid.join(sq, ["doc_id", "n"], "left")
                    .select("doc_id", "n", F.coalesce("l2", F.lit(0.0)).alias("l2")))
