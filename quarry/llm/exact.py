"""Exact deduplication with a heavy-hitter split (DataFrame functions only).

A text's digest is SHA-256 over its UTF-8 bytes after lower-casing A-Z. Digests that many rows
carry would each land in one reduce task, so they never meet a row shuffle:

1. ``approx_top_k``, a Misra-Gries style frequent-items sketch built map-side and merged, names
   at most ``max_heavy`` frequent digests. The sketch's size is fixed by ``tracked``.
2. Their exact counts and winners come from one aggregate (combined map-side, one row a digest):
   that verifies the sketch, which may over- or under-estimate but only steers the plan.
3. The winners, at most ``max_heavy`` digest keys, are broadcast; rows they match are decided
   map-side. All other rows shuffle by digest as usual.

Defined results: null text counts as empty; of equal texts the row with the largest id stays, a
null id being the smallest; rows that repeat both id and text are one group in which exactly one
row stays; an empty table gives an empty result; other columns are never read, and may have any names:
those used here are chosen among the free ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import free_name, lower_ascii, stored, text_of


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest) of every row; digest is the 32-byte SHA-256 of the normalised text."""
    return docs.select(F.col(id_col).alias("id"),
                       F.unhex(F.sha2(lower_ascii(text_of(text_col)), 256)).alias("digest"))


def frequent(rows: DataFrame, max_heavy: int, tracked: int) -> list[int]:
    """Hash keys of digests that hold about 1/tracked of the rows or more, at most ``max_heavy``.

    The sketch is fed a 64-bit key of the digest; a rare key collision only sends one more digest
    down the broadcast path, where full digests are compared.
    """
    found = rows.select(F.xxhash64("digest").alias("key")).agg(
        F.expr(f"approx_top_k(key, {int(max_heavy)}, {int(tracked)})").alias("top"),
        F.count("*").alias("n")).first()
    if not found["n"]:
        return []
    least = max(2, found["n"] // tracked)
    return [int(x["item"]) for x in found["top"] if x["item"] is not None and x["count"] >= least]


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_heavy: int = 64, tracked: int = 8192) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, digest (binary), row."""
    rows = stored(digests(docs, id_col, text_col)
                  .withColumn("row", F.monotonically_increasing_id()), "digests")
    heavy = frequent(rows, max_heavy, tracked)
    best = F.max(F.struct("id", "row"))
    size = F.count("*")
    is_heavy = F.xxhash64("digest").isin(heavy) if heavy else F.lit(False)

    rest = rows.filter(~is_heavy)
    group = Window.partitionBy("digest")
    decided = rest.select("id", "row", "digest", best.over(group).alias("best"),
                          size.over(group).alias("group_size"))
    if heavy:
        winners = rows.filter(is_heavy).groupBy("digest").agg(best.alias("best"),
                                                              size.alias("group_size"))
        # at most max_heavy keys: the bound that permits the broadcast
        decided = decided.unionByName(
            rows.filter(is_heavy).join(F.broadcast(winners), "digest")
            .select("id", "row", "digest", "best", "group_size"))
    return decided.select(
        "id", F.col("best.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), "digest", "row")


def keep_unique(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                **options) -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, all columns unchanged."""
    decided = exact_dedup(docs, id_col, text_col, **options)
    own, i, digest, n = extra = [free_name(docs.columns, x) for x in ("own", "of_id", "of_digest", "of_n")]
    kept = decided.groupBy("id", "digest").agg(F.max("kept").alias("any_kept"), F.count("*").alias("n")) \
        .filter("any_kept").select(F.col("id").alias(i), F.col("digest").alias(digest), F.col("n").alias(n))
    marked = docs.withColumn(own, F.unhex(F.sha2(lower_ascii(text_of(text_col)), 256))).join(
        kept, docs[id_col].eqNullSafe(F.col(i)) & (F.col(own) == F.col(digest)))
    # rows that repeat id and text: one of them stays
    once = marked.filter(F.col(n) == 1).drop(*extra)
    repeated = marked.filter(F.col(n) > 1).dropDuplicates([i, digest]).drop(*extra)
    return once.unionByName(repeated)
