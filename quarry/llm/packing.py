"""Best-fit packing with certified bounds and repacking.

Documents become token pieces of at most ``capacity`` tokens (only longer documents are cut; the
first piece takes the remainder). Pieces that fill a sequence alone are done. The others are dealt
by hash to partitions of about ``per_partition`` pieces, and each partition is packed by best-fit
decreasing. Dual feasible functions (the identity, the Martello-Toth threshold functions and the
Fekete-Schepers rounding functions) give a lower bound on the sequences of each partition; a
partition that meets its bound is certified optimal and closed, but for its emptiest sequence.
Partitions with a gap keep their full sequences only. What they do not keep is exchanged: the documents
are dealt anew, to fewer partitions, and packed again, until one partition holds all that is left. Where a
round leaves almost as many pieces as it took (mid-sized texts whose gap is there to stay), its partitions are
closed but for their emptiest sequences, and only those are exchanged on: what is used beyond the partitions'
own bounds is at most the sum of the gaps of the partitions so closed and of the last. A hot source does not matter, since pieces are dealt by hash of their row.

Only (row, length) pairs shuffle; token ids stay where they are made, unless asked for.

Defined results: a null or empty text is one piece with the end token alone; rows that repeat are
packed each; a null id stays null; an empty table gives an empty result; other columns are never
read. Documents of any length are cut in one pass over their ids.
"""

from __future__ import annotations

import base64
import functools
import zlib
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.bpe import WordEncoder, encoder_of
from quarry.llm.common import stored
from quarry.llm.hashing import slices, text_buffer

CAPACITY = 1024


@functools.lru_cache(maxsize=2)
def rank_encoder(ranks: bytes, pattern: str) -> WordEncoder:
    """The encoder of a rank file's content; same ids as the tokenizers model of that vocabulary."""
    import tiktoken
    table = {base64.b64decode(t): int(r) for t, r in map(bytes.split, ranks.splitlines())}
    return WordEncoder(tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table,
                                         special_tokens={}).encode_ordinary)


def vocabulary_encoder(vocabulary: str | bytes, pattern: str | None) -> WordEncoder:
    """The encoder of a tokenizers model (its JSON; no pattern), or of a rank file's content and pattern."""
    return encoder_of(vocabulary) if pattern is None else rank_encoder(vocabulary, pattern)


def piece_starts(n: int, capacity: int) -> list[int]:
    """Where the pieces of a document of ``n`` tokens start; all but the first are full."""
    first = n % capacity or capacity
    return [0, *range(first, n, capacity)]


def token_pieces(docs: DataFrame, ranks: str | bytes, pattern: str | None, id_col: str = "doc_id",
                 text_col: str = "text", capacity: int = CAPACITY, end_token: int = 2,
                 with_ids: bool = False) -> DataFrame:
    """id, piece, start, length, ids_crc32 (and ids) per piece."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        encoder = vocabulary_encoder(ranks, pattern)
        for whole in batches:
            for batch in slices(whole, "text"):
                ids, at = encoder.encode(*text_buffer(batch["text"]))
                at = at + np.arange(len(at))  # with the end tokens
                out = np.full(at[-1], end_token, dtype="<u4")
                body = np.ones(at[-1], dtype=bool)
                body[at[1:] - 1] = False
                out[body] = ids
                raw = memoryview(out.tobytes())
                rows, piece, start, length = [], [], [], []
                for row, n in enumerate(np.diff(at).tolist()):
                    begins = piece_starts(n, capacity)
                    rows += [row] * len(begins)
                    piece += range(len(begins))
                    start += begins
                    length += [b - a for a, b in zip(begins, [*begins[1:], n], strict=True)]
                first = [int(at[r]) + s for r, s in zip(rows, start, strict=True)]
                parts = [raw[4 * a:4 * (a + n)] for a, n in zip(first, length, strict=True)]
                columns = {
                    "id": batch["id"].take(pa.array(rows, pa.int64())),
                    "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(p) for p in parts], pa.int64())}
                if with_ids:
                    columns["ids"] = pa.array([p.tobytes() for p in parts], pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    kind = base.schema["id"].dataType.simpleString()
    return base.mapInArrow(run, f"id {kind}, piece int, start bigint, length bigint, "
                                f"ids_crc32 bigint{', ids binary' if with_ids else ''}")


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) of each item and the number of bins. ``open_rooms`` has bit r set while some
    bin has room r, so the tightest bin for an item is one bit operation away."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, used = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = open_rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = with_room[room].pop()
            if not with_room[room]:
                open_rooms ^= 1 << room
        else:
            room, chosen, used = capacity, used, used + 1
        bins[i], offsets[i] = chosen, capacity - room
        left = room - size
        if left:
            with_room[left].append(chosen)
            open_rooms |= 1 << left
    return bins, offsets, used


def lower_bound(lengths: np.ndarray, capacity: int, most_k: int = 24) -> int:
    """The best of the dual-feasible-function bounds on the number of bins."""
    count = np.bincount(lengths, minlength=capacity + 1)
    size = np.arange(capacity + 1, dtype=np.int64)
    best = ceil(int((count * size).sum()) / capacity)
    number, total = np.cumsum(count), np.cumsum(count * size)
    cut = np.arange(1, capacity // 2 + 1)  # sizes over capacity - cut count full, under cut not at all
    weighed = (number[-1] - number[capacity - cut]) * capacity + total[capacity - cut] - total[cut - 1]
    if len(cut):
        best = max(best, int(-(-weighed.max() // capacity)))
    for k in range(1, most_k + 1):  # x -> x where (k+1)x is whole, else floor((k+1)x)/k
        exact = (k + 1) * size % capacity == 0
        units = np.where(exact, k * size, (k + 1) * size // capacity * capacity)
        best = max(best, -(-int((count * units).sum()) // (k * capacity)))
    return best


def pack_partition(lengths: np.ndarray, capacity: int, closing: bool = False) -> dict:
    """One partition packed: bin, offset, bins, bound, and loose (its bin goes to the exchange). With
    ``closing``, a gap is accepted and the emptiest bin alone is loose."""
    bins, offsets, used = best_fit_decreasing(lengths, capacity)
    bound = lower_bound(lengths, capacity)
    filled = np.bincount(bins, weights=lengths, minlength=used)
    if used > bound and not closing:
        loose = filled[bins] < capacity
    else:  # optimal but for the remainder, which the remainders of other partitions may fill up
        loose = (bins == int(np.argmin(filled))) & (filled.min() < capacity)
    return {"bin": bins, "offset": offsets, "bins": used, "bound": bound, "loose": loose}


def pack(pieces: DataFrame, capacity: int = CAPACITY, per_partition: int = 60_000,
         max_rounds: int = 8) -> DataFrame:
    """``pieces`` (as ``token_pieces`` gives, stored) with sequence_id and offset.

    Rounds go on after ``max_rounds`` while each leaves a twentieth less, then close the gaps, on half as many
    partitions each, until one holds all that is left.

    sequence_id: 2**62 + row for pieces that fill a sequence, else round, partition and bin.
    """
    rows = stored(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    loose = rows.filter(F.col("length") < capacity).select("row", "length")
    n = loose.count()
    schema = "row bigint, length bigint, sequence_id bigint, offset bigint, loose boolean"
    placed = []

    def packer(number: int, last: bool, closing: bool):
        def run(key, table):
            got = pack_partition(table["length"].to_numpy(), capacity, closing)
            first = (number << 56) | (key[0].as_py() << 28)
            return pa.table({
                "row": table["row"], "length": table["length"],
                "sequence_id": pa.array(first + got["bin"], pa.int64()),
                "offset": pa.array(got["offset"], pa.int64()),
                "loose": pa.array(got["loose"] & (not last), pa.bool_())})
        return run

    number, closing, parts = 0, False, None
    while n:
        wanted = ceil(n / per_partition)
        parts = max(1, min(wanted, parts // 2) if closing and parts else wanted)
        last = parts == 1
        dealt = loose.withColumn("part", F.pmod(F.xxhash64(F.lit(number), "row"), F.lit(parts)))
        done = stored(dealt.groupBy("part").applyInArrow(packer(number, last, closing), schema),
                      f"round{number}")
        placed.append(done.filter(~F.col("loose")).select("row", "sequence_id", "offset"))
        if last:
            break
        loose = done.filter("loose").select("row", "length")
        before, n, number = n, loose.count(), number + 1
        # 64 numbers of rounds: 32 at most are exact, and those that close halve the partitions
        closing = closing or (number >= max_rounds - 1 and 20 * n > 19 * before) or number >= 32
    full = rows.filter(F.col("length") >= capacity).withColumns({
        "sequence_id": F.lit(1 << 62) + F.col("row"), "offset": F.lit(0).cast("long")})
    columns = [c for c in rows.columns if c != "row"] + ["sequence_id", "offset"]
    if not placed:
        return full.select(columns)
    spots = functools.reduce(DataFrame.unionByName, placed)
    return full.select(columns).unionByName(
        rows.filter(F.col("length") < capacity).join(spots, "row").select(columns))


def pack_documents(docs: DataFrame, ranks: str | bytes, pattern: str | None, id_col: str = "doc_id",
                   text_col: str = "text", capacity: int = CAPACITY, end_token: int = 2,
                   with_ids: bool = False, **options) -> DataFrame:
    return pack(token_pieces(docs, ranks, pattern, id_col, text_col, capacity, end_token, with_ids),
                capacity, **options)
