"""Removal of repeated passages by a distributed, anchored suffix array.

Every ``length``-byte string that starts at two places or more (anywhere, the same text included) is
removed wherever it stands; strings are judged on the input.

*Anchors.* Sorting every suffix would move the corpus hundreds of times over. Each window of ``length``
bytes instead names an anchor: the position in it whose ``gram``-byte string has the least hash, the
leftmost of equals. The anchor depends on the window's bytes alone, so equal windows have it at the same
offset. Neighbouring windows share theirs; such a run of windows is one record, and its text (all
its windows together, under 2 * length bytes) holds a run's worth of suffixes at their anchor.

1. One pass over the texts makes the records. Records with equal text within a slice are settled there.
2. Records shuffle by the hash of their gram (fixed-size rows, no text), those of grams that a sample shows to
   be hot by their text as well. Equal records anywhere settle each other whole; grams that occur with one text
   only are done. What remains are grams with different texts around them: the edges of repeated passages.
3. The texts of those are fetched and range-partitioned by their leading tokens at the anchor (the whole gram),
   with sampled splitters. Each bucket sorts the suffixes to the right of the anchors, and the reversed
   prefixes to the left, by multikey quicksort on 8-byte tokens, level by level. The common
   prefixes of neighbours then tell, for each offset of the anchor in a window, which windows are equal.
4. Equal leading tokens share a bucket, so buckets need no look across their boundaries, except grams so
   frequent that they would fill a bucket (over ``hot`` different texts). Those are compared across
   buckets, window by window, through a shuffle of 128-bit digests that is combined map-side.

Defined results: a null text counts as empty; texts under ``length`` bytes lose nothing; rows that repeat
id and text repeat each other, so they lose all that is covered; null ids are treated like others; an
empty table gives an empty result; other columns are kept as they are and may have any names: those used
here are chosen among the free ones.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import free_name, stored, text_of
from quarry.llm.hashing import BLOCK, mix, powers, slices, text_buffer

LENGTH, GRAM = 400, 64
PLACE = 22  # bits for a position within a slice
RECORD = ("h bigint, digest binary, id {id}, th bigint, a bigint, p1 bigint, p2 bigint, cnt bigint, "
          "settled boolean")


def gram_hashes(buf: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hash of the ``gram`` bytes from each position."""
    up, down = powers()
    n = len(buf) - gram + 1
    out = np.empty(max(n, 0), dtype=np.uint64)
    step = BLOCK - gram
    for first in range(0, n, step):
        part = buf[first:first + step + gram - 1]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:len(part)], dtype=np.uint64, out=sums[1:])
        m = len(part) - gram + 1
        out[first:first + m] = mix((sums[gram:gram + m] - sums[:m]) * down[:m])
    return out


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` values in a row, from running minima of blocks both ways."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.uint64(2**64 - 1))
    padded[:len(values)] = values
    table = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).reshape(-1)
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def window_runs(buf: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(row, anchor, first, last, hash) of all runs of windows that share their anchor; positions
    are in the buffer, ``first`` and ``last`` are starts of windows."""
    found = []
    width = length - gram + 1
    limit = (1 << PLACE) - length
    for begin in range(0, max(len(buf) - length + 1, 0), limit):
        part = buf[begin:begin + limit + length - 1]
        if len(part) < length:
            break
        h = gram_hashes(part, gram)
        place = np.arange(len(h), dtype=np.uint64)
        least = sliding_least((h >> np.uint64(PLACE)) << np.uint64(PLACE) | place, width)
        anchor = (least & np.uint64((1 << PLACE) - 1)).astype(np.int64)
        at = np.arange(len(anchor)) + begin
        row = np.searchsorted(offsets, at, side="right") - 1
        valid = at + length <= offsets[np.minimum(row + 1, len(offsets) - 1)]
        start = valid.copy()
        start[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
        stop = valid.copy()
        stop[:-1] &= ~valid[1:] | (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
        s, e = np.flatnonzero(start), np.flatnonzero(stop)
        found.append((row[s], anchor[s] + begin, at[s], at[e], h[anchor[s]]))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def records(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """One row a record (``docs`` has __id, __th, __text), positions within the text. ``settled``
    rows are spans that records with equal text in the same slice have covered."""
    def run(batches):
        for whole in batches:
            for batch in slices(whole, "__text"):
                buf, offsets = text_buffer(batch["__text"])
                row, a, p1, p2, h = window_runs(buf, offsets, length, gram)
                raw = buf.tobytes()
                digest = [hashlib.blake2b(raw[x:y + length], digest_size=16).digest()
                          for x, y in zip(p1.tolist(), p2.tolist(), strict=True)]
                first: dict[bytes, int] = {}
                count: dict[bytes, int] = {}
                for i, d in enumerate(digest):
                    first.setdefault(d, i)
                    count[d] = count.get(d, 0) + 1
                one = np.array(list(first.values()), dtype=np.int64)
                many = np.array([i for i, d in enumerate(digest) if count[d] > 1], dtype=np.int64)
                # settled runs of a text that touch become one span
                ends = p2[many]
                joined = np.ones(len(many), dtype=bool)
                if len(many):
                    joined[1:] = (row[many][1:] != row[many][:-1]) | (p1[many][1:] > ends[:-1] + length)
                group = np.cumsum(joined) - 1
                last = np.zeros(int(joined.sum()), dtype=np.int64)
                np.maximum.at(last, group, ends)
                heads = many[joined]
                base = offsets[row]
                pick = np.concatenate([one, heads])
                rows = pa.array(row[pick], pa.int64())
                n, m = len(one), len(heads)
                stop = np.concatenate([p2[one], last])
                yield pa.RecordBatch.from_pydict({
                    "h": pa.array(h[pick].view(np.int64)),
                    "digest": pa.array([digest[i] for i in one.tolist()] + [None] * m, pa.binary()),
                    "id": batch["__id"].take(rows), "th": batch["__th"].take(rows),
                    "a": pa.array(a[pick] - base[pick]), "p1": pa.array(p1[pick] - base[pick]),
                    "p2": pa.array(stop - base[pick]),
                    "cnt": pa.array([count[digest[i]] for i in one.tolist()] + [0] * m, pa.int64()),
                    "settled": pa.array([False] * n + [True] * m, pa.bool_())})

    return docs.mapInArrow(run, RECORD.format(id=docs.schema["__id"].dataType.simpleString()))


def multikey_sort(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of a matrix of big-endian 8-byte tokens, and the bytes that each row has in
    common with the one before it. Multikey quicksort, all groups of a level at a time: rows still tied
    are parted by their next token."""
    n, depth = tokens.shape
    order = np.arange(n)
    tied = np.ones(n, dtype=bool)  # with the row before
    common = np.full(n, 8 * depth, dtype=np.int64)
    if n:
        tied[0], common[0] = False, 0
    for level in range(depth):
        next_tied = np.append(tied[1:], False)
        at = np.flatnonzero(tied | next_tied)
        if not len(at):
            break
        group = np.cumsum(~tied)[at]
        token = tokens[order[at], level]
        by = np.lexsort((token, group))
        order[at] = order[at][by]
        token = token[by]
        differ = np.zeros(len(at), dtype=np.uint64)
        differ[1:] = token[1:] ^ token[:-1]
        parted = tied[at] & (differ != 0)
        bits = np.frexp(differ[parted].astype(np.float64))[1]  # bit length, at worst one too many
        over = (differ[parted] >> (bits - 1).astype(np.uint64)) == 0
        common[at[parted]] = 8 * level + (64 - (bits - over)) // 8
        tied[at[parted]] = False
    return order, common


def token_matrix(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int,
                 step: int) -> np.ndarray:
    """``width`` bytes from each start onwards (step 1) or backwards (-1), zero beyond ``lengths``, as
    big-endian tokens."""
    along = np.arange(width)
    inside = along[None, :] < lengths[:, None]
    at = np.where(inside, starts[:, None] + step * along[None, :], 0)
    table = np.where(inside, raw[at] if len(raw) else 0, 0).astype(np.uint8)
    return np.ascontiguousarray(table).view(">u8").astype(np.uint64)


def covered_offsets(texts: list[bytes], left: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For records (text, bytes before the anchor): least and greatest offset of the anchor in a window
    that equals a window of another record; -1 where there is none."""
    n = len(texts)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    begin = np.cumsum(sizes) - sizes
    raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
    least_off, most_off = left - (sizes - length), left  # anchor offsets of the last and first window
    wide = -(-length // 8) * 8
    right_order, right_common = multikey_sort(
        token_matrix(raw, begin + left, sizes - left, wide, 1))
    left_order, left_common = multikey_sort(token_matrix(raw, begin + left - 1, left, wide, -1))
    right_rank, left_rank = np.empty(n, np.int64), np.empty(n, np.int64)
    right_rank[right_order], left_rank[left_order] = np.arange(n), np.arange(n)
    low, high = np.full(n, -1), np.full(n, -1)
    for d in range(int(least_off.min()), int(most_off.max()) + 1):
        live = np.flatnonzero((least_off <= d) & (d <= most_off))
        if len(live) < 2:
            continue
        right = np.cumsum(right_common < length - d)[right_rank[live]]
        left_class = np.cumsum(left_common < d)[left_rank[live]]
        key = right * (n + 1) + left_class
        by = np.argsort(key, kind="stable")
        same = key[by][1:] == key[by][:-1]
        again = np.zeros(len(live), dtype=bool)
        again[by[1:][same]] = True
        again[by[:-1][same]] = True
        hit = live[again]
        low[hit] = np.where(low[hit] < 0, d, low[hit])
        high[hit] = d
    return low, high


def hot_records(docs: DataFrame, length: int, gram: int, share: int = 16, least: int = 64) -> tuple[DataFrame, DataFrame]:
    """(h, busy) of grams, and (h, digest, often) of records, that many rows have, by a sample of one in ``share`` documents:
    at most 8 a shuffle partition of either. They only steer how rows are dealt: a busy gram counts as one with
    different texts, which at most fetches a text in vain, and a record that is often in the sample is one that
    stands in several places (``least`` is over 1)."""
    spark = docs.sparkSession
    most = 8 * int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    some = docs.filter(F.pmod(F.xxhash64(F.lit(3), "__id", "__th"), F.lit(share)) == 0)
    seen = stored(records(some, length, gram).filter("not settled").groupBy("h", "digest").agg(F.sum("cnt").alias("n")),
                  "sample")
    rows = seen.agg(F.sum("n")).first()[0] or 0
    enough = max(least, rows // most)
    grams = seen.groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= enough)
    pairs = seen.filter(F.col("n") >= enough)
    # n >= rows / most, so at most ``most`` rows each
    return (stored(grams.select("h", F.lit(True).alias("busy")), "grams"),
            stored(pairs.select("h", "digest", F.lit(True).alias("often")), "pairs"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = 20_000,
                   bucket_bytes: int = 8 << 20) -> DataFrame:
    """(id, th, start, stop) of covered byte ranges, not merged; ``docs`` has __id, __th, __text."""
    kind = docs.schema["__id"].dataType.simpleString()
    grams, pairs = hot_records(docs, length, gram)
    # a hot gram's records are dealt by their text too, those of a hot text by their place
    spread = F.when(F.col("often"), F.xxhash64("id", "th", "p1")).when(F.col("busy"), F.xxhash64("digest")) \
        .otherwise(F.lit(0))
    dealt = (records(docs, length, gram).join(F.broadcast(grams), "h", "left").join(F.broadcast(pairs), ["h", "digest"], "left")
             .withColumns({"busy": F.col("busy").isNotNull(), "often": F.col("often").isNotNull()})
             .withColumn("salt", F.when(F.col("busy"), F.pmod(spread, F.lit(1 << 16))).otherwise(F.lit(0))))
    by_gram, by_text = Window.partitionBy("h", "salt"), Window.partitionBy("h", "salt", "digest")
    marked = (dealt.repartition("h", "salt")
              .withColumn("total", F.sum("cnt").over(by_text) + F.when(F.col("often"), 1).otherwise(0))
              .withColumn("mixed", F.col("busy") | (F.min("digest").over(by_gram) != F.max("digest").over(by_gram)))
              .withColumn("open", F.col("busy") | (
                  F.min(F.when(~F.col("settled"), F.col("total"))).over(by_gram) == 1))
              .drop("busy", "often", "salt"))
    seen = stored(marked.filter("settled or total > 1 or mixed"), "records")
    whole = seen.filter("settled or (total > 1 and cnt = 1)").select(
        "id", "th", F.col("p1").alias("start"), (F.col("p2") + length).alias("stop"))

    members = seen.filter("mixed and open and not settled").groupBy("h", "digest").agg(
        F.min(F.struct("th", "a", "p1", "p2", "id")).alias("m"), F.max("total").alias("total")).select(
        "h", "digest", "total", F.col("m.id").alias("id"), F.col("m.th").alias("th"),
        F.col("m.a").alias("a"), F.col("m.p1").alias("p1"), F.col("m.p2").alias("p2"))
    wanted = members.groupBy(F.col("id").alias("w_id"), F.col("th").alias("w_th")).agg(
        F.collect_list(F.struct("h", "digest", "total", "a", "p1", "p2")).alias("parts"))
    fetched = docs.join(wanted, docs["__id"].eqNullSafe(F.col("w_id")) & (docs["__th"] == F.col("w_th")))

    def cut(batches):
        for whole_batch in batches:
            for batch in slices(whole_batch, "__text"):
                out = {k: [] for k in ("h", "digest", "total", "row", "a", "p1", "text")}
                for i, (text, parts) in enumerate(zip(batch["__text"].to_pylist(),
                                                      batch["parts"].to_pylist(), strict=True)):
                    raw = (text or "").encode()
                    for x in parts:
                        for k in ("h", "digest", "total", "a", "p1"):
                            out[k].append(x[k])
                        out["row"].append(i)
                        out["text"].append(raw[x["p1"]:x["p2"] + length])
                rows = pa.array(out["row"], pa.int64())
                yield pa.RecordBatch.from_pydict({
                    "h": pa.array(out["h"], pa.int64()), "digest": pa.array(out["digest"], pa.binary()),
                    "total": pa.array(out["total"], pa.int64()), "id": batch["__id"].take(rows),
                    "th": batch["__th"].take(rows), "a": pa.array(out["a"], pa.int64()),
                    "p1": pa.array(out["p1"], pa.int64()), "text": pa.array(out["text"], pa.binary()),
                    "lead": pa.array([t[a - p:a - p + gram] for t, a, p in zip(
                        out["text"], out["a"], out["p1"], strict=True)], pa.binary())})

    cut_schema = (f"h bigint, digest binary, total bigint, id {kind}, th bigint, a bigint, p1 bigint, "
                  "text binary, lead binary")
    # rows that repeat id and text bring the same record twice
    texts = stored(fetched.select("__id", "__th", "__text", "parts").mapInArrow(cut, cut_schema),
                   "suffixes").dropDuplicates(["h", "digest"])
    frequent = texts.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") > hot).select("h")
    total = texts.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = max(1, -(-total // bucket_bytes))

    def compare(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got)
        a, p1 = table["a"].to_numpy(), table["p1"].to_numpy()
        low, high = covered_offsets(table["text"].to_pylist(), a - p1, length)
        keep = np.flatnonzero((low >= 0) & (table["total"].to_numpy() == 1))
        rows = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_pydict({
            "id": table["id"].combine_chunks().take(rows), "th": table["th"].combine_chunks().take(rows),
            "start": pa.array(a[keep] - high[keep], pa.int64()),
            "stop": pa.array(a[keep] - low[keep] + length, pa.int64())})

    spans = f"id {kind}, th bigint, start bigint, stop bigint"
    frequent = F.broadcast(frequent)  # of over ``hot`` rows each, so their number is at most rows / hot
    edges = (texts.join(frequent, "h", "left_anti").repartitionByRange(parts, "lead")
             .select("total", "id", "th", "a", "p1", "text").mapInArrow(compare, spans))

    def digests(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                one = batch.slice(k, 512)
                at, place, window = [], [], []
                for i, (text, p) in enumerate(zip(one["text"].to_pylist(), one["p1"].to_pylist(),
                                                  strict=True)):
                    for x in range(len(text) - length + 1):
                        at.append(i)
                        place.append(p + x)
                        window.append(hashlib.blake2b(text[x:x + length], digest_size=16).digest())
                rows = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_pydict({
                    "window": pa.array(window, pa.binary()), "id": one["id"].take(rows),
                    "th": one["th"].take(rows), "start": pa.array(place, pa.int64()),
                    "total": one["total"].take(rows)})

    windows = texts.join(frequent, "h").select("text", "id", "th", "p1", "total").mapInArrow(
        digests, f"window binary, id {kind}, th bigint, start bigint, total bigint")
    twice = windows.groupBy("window").agg(F.count("*").alias("n")).filter("n > 1").select("window")
    across = windows.filter("total = 1").join(twice, "window").select(
        "id", "th", "start", (F.col("start") + length).alias("stop"))
    return whole.unionByName(edges).unionByName(across)


def with_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
               **options) -> tuple[DataFrame, str, str]:
    """``docs`` with two columns more, whose names are returned: the text (null: empty) and its covered ranges
    (array of start and stop; null: none)."""
    text, spans, th, of, oth = (free_name(docs.columns, x) for x in ("whole_text", "spans", "text_hash", "of_id", "of_hash"))
    keyed = docs.select(F.col(id_col).alias("__id"), text_of(text_col).alias("__text")).withColumn(
        "__th", F.xxhash64("__text"))
    found = repeated_spans(keyed.select("__id", "__th", "__text"), length, **options)
    per_text = found.groupBy(F.col("id").alias(of), F.col("th").alias(oth)).agg(
        F.collect_set(F.struct("start", "stop")).alias(spans))
    own = docs.withColumn(text, text_of(text_col)).withColumn(th, F.xxhash64(text))
    joined = own.join(per_text, own[id_col].eqNullSafe(F.col(of)) & (F.col(th) == F.col(oth)), "left")
    return joined.drop(of, oth, th), text, spans


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for x in sorted((s["start"], s["stop"]) for s in spans or []):
        if out and x[0] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], x[1]))
        else:
            out.append(x)
    return out


def remaining(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    if not spans:
        return raw
    edges = [0, *[x for s in spans for x in s], len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def removal_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   **options) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 per row."""
    joined, text, spans = with_spans(docs.select(id_col, text_col), id_col, text_col, **options)
    joined = joined.select(F.col(id_col).alias("id"), F.col(text).alias("__text"), F.col(spans).alias("__spans"))

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "__text"):
                raw = [x.encode() for x in batch["__text"].to_pylist()]
                spans = [merged(x) for x in batch["__spans"].to_pylist()]
                yield pa.RecordBatch.from_pydict({
                    "id": batch["id"], "n_bytes": pa.array([len(x) for x in raw], pa.int64()),
                    "n_removed": pa.array([sum(b - a for a, b in s) for s in spans], pa.int64()),
                    "n_spans": pa.array([len(s) for s in spans], pa.int64()),
                    "kept_sha256": pa.array([hashlib.sha256(remaining(x, s)).hexdigest()
                                             for x, s in zip(raw, spans, strict=True)], pa.string())})

    kind = joined.schema["id"].dataType.simpleString()
    return joined.mapInArrow(run, f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, "
                                  "kept_sha256 string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   **options) -> DataFrame:
    """``docs`` with the covered bytes taken out of the text; bytes of a character that a cut has
    split go with them. A null text stays null."""
    columns = docs.columns
    joined, text, spans = with_spans(docs, id_col, text_col, **options)

    def run(batches):
        for whole in batches:
            for batch in slices(whole, text):
                new = [None if t is None else remaining(t.encode(), merged(s)).decode(errors="ignore")
                       if s else t
                       for t, s in zip(batch[text_col].to_pylist(), batch[spans].to_pylist(),
                                       strict=True)]
                yield pa.RecordBatch.from_pydict({
                    c: pa.array(new, pa.string()) if c == text_col else batch[c] for c in columns})

    return joined.mapInArrow(run, docs.schema)
