"""Removal of lines that stand in many documents (DataFrame functions only).

A line's key is the line without blanks (bytes 9-13 and 32) at its ends, A-Z lower-cased. Keys of at least
``least_chars`` code points found in at least ``least_docs`` documents lose all their lines except in
the document with the largest id that holds them. No text is shuffled to decide that:

1. Every eligible line becomes a record of fixed size: 128 bits of its key, the document's id, 128 bits naming
   the row (id and text) and the line's place. Records are written to the shared folder.
2. A frequent-items sketch, merged in two levels, names keys that hold about a 1/8 of a task's fair
   share of the records or more (8 a partition at most). Their documents are counted and their keepers found by
   aggregates that combine map-side; these verdicts are broadcast (that number is the bound) and
   applied where the records lie, so no hot key is ever gathered. The sketch only steers the plan.
3. All other records are range-partitioned by hash and sorted by hash, document (largest first) and place. A
   window streams over each key: the first document stays, lines of later ones are drops if a third one follows.
4. Drops go to their document, where they become a keep bitmap: 64 lines a word, words without a drop
   left out (their lines all stay).

Defined results: null or empty text is one empty line; rows that share an id are one document and are cut
alike; null ids are one document, the smallest; an empty table gives an empty result; other columns
are kept as they are, whatever their names. Two keys or rows meet wrongly with a chance of 2**-128 a pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import free_name, lower_ascii, stored, text_of

BLANKS = " \t\n\x0b\x0c\r"
LEAST_CHARS, LEAST_DOCS = 20, 3
WORD = 64  # lines a word of the bitmap


def row_key(id_col: Column, text: Column) -> tuple[Column, Column]:
    """128 bits that name a row by its id and whole text (rows that repeat both share them)."""
    return (F.xxhash64(id_col.isNull(), id_col, text), F.xxhash64(F.lit(13), id_col.isNull(), text, id_col))


def records(docs: DataFrame, id_col: str, text_col: str, least_chars: int) -> DataFrame:
    """(h1, h2, id, r1, r2, pos) of every line that is long enough."""
    text = text_of(text_col)
    r1, r2 = row_key(F.col(id_col), text)
    lines = docs.select(F.col(id_col).alias("id"), r1.alias("r1"), r2.alias("r2"),
                        F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    keyed = lines.select("id", "r1", "r2", "pos",
                         lower_ascii(F.btrim("line", F.lit(BLANKS))).alias("key")) \
        .filter(F.length("key") >= least_chars)
    return keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(13), "key").alias("h2"),
                        "id", "r1", "r2", "pos")


def hot_keys(rows: DataFrame, partitions: int) -> DataFrame:
    """(h1) of keys with an estimated share of 1/(8 * partitions) or more, 8 * partitions rows at most.

    Sketches of tasks meet in groups first, so no task merges all of them.
    """
    most = min(8 * partitions, 100_000)
    tracked = min(4 * most, 1_000_000)
    parts = rows.groupBy(F.expr("pmod(spark_partition_id(), 64)").alias("part")).agg(
        F.expr(f"approx_top_k_accumulate(h1, {tracked})").alias("sketch"), F.count("*").alias("n"))
    whole = parts.groupBy(F.lit("all")).agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"),
                                        F.sum("n").alias("n"))  # no row if there are no records
    found = whole.select("n", F.explode(F.expr(f"approx_top_k_estimate(sketch, {most})")).alias("x"))
    return found.filter((F.col("x.count") * most >= F.col("n")) & (F.col("x.count") >= 1000)) \
        .select(F.col("x.item").alias("h1"))


def dropped_lines(rows: DataFrame, least_docs: int, partitions: int) -> DataFrame:
    """(r1, r2, pos) of the lines that go."""
    hot = stored(hot_keys(rows, partitions), "hot")  # 8 * partitions rows at most
    often = rows.join(F.broadcast(hot), "h1")
    verdict = often.groupBy("h1", "h2").agg(F.countDistinct(F.struct("id")).alias("n"),
                                            F.max(F.struct("id")).alias("keeper")) \
        .filter(F.col("n") >= least_docs)
    from_hot = often.join(F.broadcast(verdict), ["h1", "h2"]).filter(
        ~F.col("id").eqNullSafe(F.col("keeper.id"))).select("r1", "r2", "pos")

    rest = rows.join(F.broadcast(hot), "h1", "left_anti").repartitionByRange(partitions, "h1", "h2") \
        .sortWithinPartitions("h1", "h2", F.col("id").desc_nulls_last(), "pos")
    key = Window.partitionBy("h1", "h2")
    streamed = rest.withColumn("nth", F.dense_rank().over(key.orderBy(F.col("id").desc_nulls_last()))) \
        .withColumn("n", F.max("nth").over(key))
    from_rest = streamed.filter((F.col("nth") > 1) & (F.col("n") >= least_docs)).select("r1", "r2", "pos")
    return from_hot.unionByName(from_rest)


def bitmaps(dropped: DataFrame) -> DataFrame:
    """(r1, r2, keep) per row with a drop: array of (word, bits) in order, bit i of word w being line
    64 w + i, 1 where it stays; words that are not there are all ones."""
    words = dropped.repartition("r1", "r2").groupBy(
        "r1", "r2", F.expr(f"pos div {WORD}").cast("int").alias("word")).agg(
        F.expr(f"bit_or(shiftleft(1L, cast(pos % {WORD} as int)))").alias("gone"))
    return words.groupBy("r1", "r2").agg(F.sort_array(F.collect_list(F.struct(
        "word", F.bitwise_not("gone").alias("bits")))).alias("keep"))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(r1, r2, keep) of every row of ``docs`` that loses a line; the key is ``row_key``."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    rows = stored(records(docs, id_col, text_col, least_chars), "lines")
    return bitmaps(dropped_lines(rows, least_docs, partitions))


def dense(keep: Column) -> Column:
    """The words of a bitmap without gaps, so that a line's bit is found by its index."""
    filled = F.transform(keep, lambda x, i: F.concat(
        F.array_repeat(F.lit(-1).cast("long"),
                       x["word"] - F.when(i > 0, F.get(keep, i - 1)["word"]).otherwise(F.lit(-1)) - 1),
        F.array(x["bits"])))
    return F.flatten(filled)


def kept_lines(lines: Column, words: Column) -> Column:
    """Those of ``lines`` whose bit in ``words`` (dense) is 1; lines beyond the words stay."""
    return F.filter(lines, lambda _, i: F.coalesce(
        F.getbit(F.get(words, F.shiftright(i, 6)), i % WORD) == 1, F.lit(True)))


def with_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 **options) -> tuple[DataFrame, str]:
    """``docs`` with one column more, whose name is returned: struct of the sparse bitmap ``keep``, its dense
    ``words`` and the number of lines ``gone``; null where all lines stay."""
    found = keep_bitmaps(docs, id_col, text_col, **options)
    mark, k1, k2 = (free_name(docs.columns, x) for x in ("bitmap", "key1", "key2"))
    gone = F.aggregate("keep", F.lit(0).cast("long"),
                       lambda total, x: total + F.bit_count(F.bitwise_not(x["bits"])))
    found = found.select(F.col("r1").alias(k1), F.col("r2").alias(k2), F.struct(
        "keep", dense(F.col("keep")).alias("words"), gone.alias("gone")).alias(mark))
    r1, r2 = row_key(F.col(id_col), text_of(text_col))
    joined = docs.withColumns({k1: r1, k2: r2}).join(found, [k1, k2], "left")
    return joined.select(*docs.columns, mark), mark


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                **options) -> DataFrame:
    """One row per row of ``docs``: id, n_lines, n_dropped, keep (the bitmap, empty where all stay),
    clean_text (the remaining lines joined by line feeds)."""
    marked, mark = with_bitmaps(docs.select(id_col, text_col), id_col, text_col, **options)
    lines = F.split(text_of(text_col), "\n", -1)
    return marked.select(
        F.col(id_col).alias("id"), F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.col(mark)["gone"], F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce(F.col(mark)["keep"], F.expr("cast(array() as array<struct<word:int,bits:bigint>>)"))
        .alias("keep"),
        F.when(F.col(mark).isNull(), text_of(text_col)).otherwise(
            F.array_join(kept_lines(lines, F.col(mark)["words"]), "\n")).alias("clean_text"))


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the dropped lines taken out of the text; all columns stay. A null text stays null."""
    marked, mark = with_bitmaps(docs, id_col, text_col, **options)
    new = F.when(F.col(mark).isNull(), F.col(text_col)).otherwise(F.array_join(
        kept_lines(F.split(F.col(text_col), "\n", -1), F.col(mark)["words"]), "\n"))
    return marked.withColumn(text_col, new).drop(mark)
