"""Delimited records whose quoted fields hold line breaks, read in parallel.

A file is split at any line. Whether a line starts inside a quoted field depends on all lines before it, but only as one
of two states, so a split is a function of two states:

1. every split says in which state it ends if it starts outside, and if it starts inside, a quoted field;
2. these functions, two bits a split, are applied in order, which gives every split's true start;
3. every split puts its own records together, in one stream; what is left at its two ends are fragments, two
   a split at most, that are joined by file and split.

A quote opens a field only at the field's start: an inch mark in a bare field (``5" disk``) is text. Inside quotes a doubled
quote is one quote. Records are then parsed by ``from_csv``.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OUT, IN, CLOSING = 0, 1, 2  # outside quotes, inside, and behind a quote that closes unless another follows


def line_end(line: str, sep: str, inside: bool) -> bool:
    """Whether a line ends inside a quoted field, if it starts outside or inside one."""
    parts = line.split('"')
    state = IN if inside else OUT
    for k in range(1, len(parts)):
        if state == OUT:
            before = parts[k - 1]
            state = IN if before.endswith(sep) or (k == 1 and not before and not inside) else OUT
        else:
            state = CLOSING if state == IN else IN
        if state == CLOSING and parts[k]:
            state = OUT
    return state == IN


def opens(line: Column, sep: str) -> Column:
    """``line_end`` of a line that starts outside quotes, as an expression."""
    parts = F.split(line, '"', -1)
    start = F.struct(F.lit(OUT).alias("state"), F.get(parts, 0).alias("before"), F.lit(True).alias("first"))

    def step(now: Column, part: Column) -> Column:
        at_start = F.endswith(now["before"], F.lit(sep)) | (now["first"] & (now["before"] == ""))
        state = F.when(now["state"] == OUT, F.when(at_start, IN).otherwise(OUT)) \
            .when(now["state"] == IN, CLOSING).otherwise(IN)
        return F.struct(F.when((state == CLOSING) & (part != ""), OUT).otherwise(state).alias("state"),
                        part.alias("before"), F.lit(False).alias("first"))

    return F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), start, step,
                       lambda now: now["state"]) == IN


def _lines(spark: SparkSession, path: str, charset: str) -> DataFrame:
    text = spark.read.text(path)
    value = F.col("value") if charset.lower() in ("utf-8", "utf8") else F.decode(F.col("value").cast("binary"), charset)
    return text.select(value.alias("value"), F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.file_block_start").alias("block"))


def _split_ends(lines: DataFrame, sep: str) -> DataFrame:
    """(file, block, out, in): the state each split ends in, by the state it starts in."""
    def run(batches):
        now, ends = None, []
        for batch in batches:
            quoted = pc.match_substring(batch["value"], '"')
            # a split's lines come one after the other; lines without quotes change nothing
            keys = pa.table({"file": batch["file"], "block": batch["block"]}).group_by(
                ["file", "block"], use_threads=False).aggregate([])
            for f, b in zip(keys["file"].to_pylist(), keys["block"].to_pylist(), strict=True):
                if now is None or now[:2] != [f, b]:
                    now = [f, b, False, True]
                    ends.append(now)
                own = pc.and_(pc.and_(pc.equal(batch["file"], f), pc.equal(batch["block"], b)), quoted)
                for line in batch["value"].filter(own).to_pylist():
                    now[2], now[3] = line_end(line, sep, now[2]), line_end(line, sep, now[3])
        yield pa.RecordBatch.from_pydict({
            "file": pa.array([x[0] for x in ends], pa.string()), "block": pa.array([x[1] for x in ends], pa.int64()),
            "out": pa.array([x[2] for x in ends], pa.bool_()), "in": pa.array([x[3] for x in ends], pa.bool_())})

    return lines.mapInArrow(run, "file string, block bigint, out boolean, in boolean")


def records(spark: SparkSession, path: str, sep: str, charset: str = "utf-8") -> DataFrame:
    """(file, record, first) of every record that is not blank; ``first`` marks each file's first record."""
    lines = _lines(spark, path, charset)
    starts: dict[tuple[str, int], bool] = {}
    file, state = None, False
    for r in sorted(_split_ends(lines, sep).collect(), key=lambda r: (r["file"], r["block"])):  # a row a split
        state = state if r["file"] == file else False
        starts[r["file"], r["block"]], file = state, r["file"]
        state = r["in"] if state else r["out"]

    def run(batches):
        key, held, inside, head, at = None, [], False, False, 0
        rows: list[tuple] = []

        def close() -> None:  # what a split leaves open is a fragment
            if key is not None and held:
                rows.append((*key, at, "\n".join(held), "head" if head and not complete else "tail"))

        complete = False
        for batch in batches:
            for line, f, b in zip(batch["value"].to_pylist(), batch["file"].to_pylist(),
                                  batch["block"].to_pylist(), strict=True):
                if (f, b) != key:
                    close()
                    key, held, at = (f, b), [], 0
                    inside = head = starts[f, b]
                    complete = False
                held.append(line)
                inside = line_end(line, sep, inside) if '"' in line else inside
                if not inside:
                    rows.append((*key, at, "\n".join(held), "end" if head and not complete else "whole"))
                    held, complete, at = [], True, at + 1
            yield _batch(rows)
            rows.clear()
        close()
        yield _batch(rows)

    made = lines.mapInArrow(run, "file string, block bigint, at bigint, record string, kind string")
    # whole records stay where they are; fragments, two a split at most, meet by the split that opened their record
    whole = made.filter("kind = 'whole'").select("file", "block", "at", "record")
    parts = made.filter("kind <> 'whole'")
    earlier = Window.partitionBy("file").orderBy("block", "at").rowsBetween(Window.unboundedPreceding, -1)
    tail = F.when(F.col("kind") == "tail", F.col("block"))
    opened = parts.withColumn("of", F.coalesce(tail, F.max(tail).over(earlier)))
    joined = opened.groupBy("file", "of").agg(
        F.sort_array(F.collect_list(F.struct("block", "at", "record"))).alias("p")).select(
        "file", F.col("of").alias("block"), F.get("p", 0)["at"].alias("at"),
        F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record"))
    every = whole.unionByName(joined)
    return every.filter(F.trim("record") != "").select(
        "file", "record", ((F.col("block") == 0) & (F.col("at") == 0)).alias("first"))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    kinds = {"file": pa.string(), "block": pa.int64(), "at": pa.int64(), "record": pa.string(), "kind": pa.string()}
    return pa.RecordBatch.from_pydict({n: pa.array(list(c), k) for (n, k), c in zip(kinds.items(), columns, strict=True)})
