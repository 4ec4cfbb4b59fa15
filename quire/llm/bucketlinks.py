"""Links between sets that share a bucket, verified exactly, without forming
all pairs of a bucket.

Input: buckets (key, id) and sets (id, sorted distinct elements). Wanted:
links (a, b) with Jaccard >= num/den whose components equal those of all such
pairs within buckets.

1. Every bucket gets a pivot and every member is verified against the pivots
   of its buckets only. A member with most bucket mates is the candidate of
   its buckets; a bucket takes the best candidate that any of its members has,
   so the buckets around one text agree on one pivot near its middle.
   Members of buckets that still hold more than one component are verified
   against one more member, drawn by hash: that only merges components early.
2. Two members linked with the pivot are in one component already. A pair
   that still matters has a member x that is not linked with the pivot p, an
   outlier. With Dx the elements in which x and p differ, x and y differ in
   |Dx| + |Dy| - 2 |Dx & Dy| elements, so a link needs a common difference.
   Members of a pivot therefore join on the first elements of their
   differences in one fixed order (elements the pivot lacks first: those are
   rare), with prefix lengths, sizes and positions that no link can escape.
   Differences of up to ``SHORT`` elements travel whole, so such pairs are
   decided in the join; the other pairs are verified on the whole sets.

The bounds, with c = (den - num) / (den + num): linked x, y differ in at most
c (|x| + |y|) elements. An outlier's prefix is floor(|x| (den - num) / num) + 1
elements (more than any partner may lack). A linked member y of p shares at
least |Dy| num / (den + num) differences with an outlier partner, which
bounds its prefix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.graph import components
from quire.llm.scratch import Scratch


SHORT = 64


def merged(rows: DataFrame, sets: DataFrame, links: DataFrame, num: int, den: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Links with those of a merging round, and the components of all."""
    placed = rows.join(components(links, scratch), "id", "left").withColumn("root", F.coalesce("root", "id"))
    mixed = scratch.keep(placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
                               .where(F.col("lo") != F.col("hi")).select("key"), "several")
    open_rows = scratch.keep(placed.join(mixed, "key", "left_semi"), "open")
    drawn = F.max(F.struct(F.xxhash64("key", "id").alias("h"), F.col("id").alias("q"), F.col("root").alias("own")))
    chosen = scratch.keep(open_rows.groupBy("key").agg(drawn.alias("top")).select("key", "top.q", "top.own"), "drawn")
    pairs = (open_rows.join(chosen, "key").where(F.col("root") != F.col("own"))
                      .select(F.least("q", "id").alias("a"), F.greatest("q", "id").alias("b")).distinct())
    links = links.unionByName(scratch.keep(verified(pairs, sets, num, den), "merges"))
    scratch.drop(open_rows, chosen, mixed)
    return links, components(links, scratch)


def shared_buckets(buckets: DataFrame) -> DataFrame:
    """``key, id`` of the keys with two or more different ids. ``buckets`` is
    dealt out by key once; the count and the rows read the same exchange."""
    dealt = buckets.select("key", "id").repartition("key")
    shared = (dealt.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
                   .where(F.col("lo") != F.col("hi")).select("key"))
    return dealt.join(shared, "key", "left_semi")


def pivots(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``p, x``: every member with the pivots of its buckets."""
    sizes = scratch.keep(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "sizes")
    degrees = scratch.keep(rows.join(sizes, "key").groupBy("id").agg(F.sum("n").alias("degree")), "degrees")
    own = degrees.select("id", F.struct("degree", F.col("id").alias("p")).alias("top"))
    for name in ("bucket", "widened"):
        best = scratch.keep(rows.join(own, "id").groupBy("key").agg(F.max("top").alias("top")), name)
        if name == "bucket":
            own = scratch.keep(rows.join(best, "key").groupBy("id").agg(F.max("top").alias("top")), "member")
    chosen = best.select("key", F.col("top.p").alias("p"))
    return rows.join(chosen, "key").where(F.col("id") != F.col("p")).select("p", F.col("id").alias("x")).distinct()


def _with_sets(pairs: DataFrame, sets: DataFrame, first: str, second: str) -> DataFrame:
    return (pairs.join(sets.select(F.col("id").alias(second), F.col("elems").alias("s2")), second)
                 .join(sets.select(F.col("id").alias(first), F.col("elems").alias("s1")), first))


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int, a: str = "a", b: str = "b") -> DataFrame:
    """``a, b`` of the pairs with Jaccard >= num/den."""
    inter = F.size(F.array_intersect("s1", "s2"))
    return (_with_sets(pairs, sets, a, b).withColumn("inter", inter)
            .where(F.lit(den) * F.col("inter") >= F.lit(num) * (F.size("s1") + F.size("s2") - F.col("inter")))
            .where("inter > 0").select(F.col(a).alias("a"), F.col(b).alias("b")))


def bucket_links(rows: DataFrame, sets: DataFrame, num: int, den: int, scratch: Scratch) -> DataFrame:
    """Links of the written bucket rows ``key, id`` (see the module's text);
    ``sets`` is a written table with every id of ``rows`` once."""
    star = _with_sets(pivots(rows, scratch), sets, "p", "x")
    # named columns first: each is used several times below
    star = star.select("p", "x", F.size("s2").alias("nx"), F.size("s1").alias("np"),
                       F.array_except("s2", "s1").alias("novel"), F.array_except("s1", "s2").alias("missing"))
    star = star.withColumn("diff", F.concat("novel", "missing")).withColumn("d", F.size("diff"))
    star = star.withColumn("linked", F.col("d") * (den + num) <= (F.col("nx") + F.col("np")) * (den - num))
    reach = F.when(F.col("linked"), F.expr(f"d - d * {num} div {den + num}")) \
             .otherwise(F.least("d", F.expr(f"nx * {den - num} div {num} + 1"))).cast("int")
    star = scratch.keep(star.select("p", "x", "nx", "d", "linked", "diff",
                                    reach.alias("reach"))
                            .select("p", "x", "nx", "d", "linked", F.slice("diff", F.lit(1), F.col("reach")).alias("head"),
                                    F.when(F.col("d") <= SHORT, F.col("diff")).alias("whole")),
                        "star")
    links = star.where("linked").select(F.col("p").alias("a"), F.col("x").alias("b"))
    outliers = star.where("not linked")
    if outliers.isEmpty():
        return links
    links, roots = merged(rows, sets, links, num, den, scratch)
    mixed = scratch.keep(outliers.select("p").distinct(), "mixed")
    members = (star.join(mixed, "p", "left_semi")
                   .join(roots.select(F.col("id").alias("x"), "root"), "x", "left")
                   .withColumn("root", F.coalesce("root", "x")))
    members = scratch.keep(members.select("p", "x", "nx", "d", "linked", "root", "whole", F.posexplode("head").alias("at", "e")), "heads")
    left = members.where("not linked").drop("linked")
    right = members.select("p", "e", *[F.col(c).alias(f"{c}2") for c in ("x", "nx", "d", "root", "whole", "at")])
    bound = F.expr(f"(nx + nx2) * {den - num} div {den + num}")
    differ = F.col("d") + F.col("d2") - 2 * F.size(F.array_intersect("whole", "whole2"))
    near = (left.join(right, ["p", "e"])
                .where((F.col("root") != F.col("root2"))
                       & (F.lit(num) * F.greatest("nx", "nx2") <= F.lit(den) * F.least("nx", "nx2"))
                       & (2 * F.least(F.col("d") - F.col("at"), F.col("d2") - F.col("at2")) >= F.col("d") + F.col("d2") - bound)
                       & (F.col("whole").isNull() | F.col("whole2").isNull() | (differ <= bound)))
                .select(F.least("x", "x2").alias("a"), F.greatest("x", "x2").alias("b")).distinct())
    return links.unionByName(verified(near, sets, num, den))
