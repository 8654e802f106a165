"""Token-ID shards in training order.

Documents become sequences of ``stride`` tokens (each ends with the end token, the last is padded). A keyed
Feistel permutation, cycle-walking from the next power of four down to the number of sequences,
gives every sequence its global slot: a bijection, so no slot is missing or used twice, and the
order depends on the key alone. Slots are dealt in ranges of ``per_shard`` to partitions, each of
which writes fixed-stride files: the sequence of slot s is found by arithmetic, a run can be read one after the
other from any slot, and reading resumes from a slot number.

Two passes over the input: the first counts the sequences of each input partition (one number a
partition reaches the driver), the second numbers, permutes and ships them. The second verifies the
count and a digest of each partition against the first and fails if the input has changed between
them. Tokens are shuffled once, as 16-bit ids. Shards are written under a temporary name and moved
into place, so a repeated task (lost executor, speculation) writes the same file again; a shard that is
there is left alone only if its bytes are those to be written. ``manifest.json`` beside the shards has the
number of sequences, where readers stop, even if an earlier run left more shards. The folder must be shared
storage (a URI that pyarrow.fs knows).

Defined results: a null or empty text is one sequence with the end token alone; rows that repeat are
written each; null ids stay; an empty table gives no shard and an empty result; other columns are never read.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.hashing import mix, slices, text_buffer
from quarry.llm.packing import vocabulary_encoder

STRIDE, PER_SHARD, PAD = 512, 8192, 50256
ROUNDS = 6


def feistel(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Slots of ``index`` under the keyed permutation of 0..n-1."""
    half = max(1, ceil(max(n - 1, 1).bit_length() / 2))
    mask, width = np.uint64((1 << half) - 1), np.uint64(half)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) + np.uint64(key % (1 << 63)))

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> width, x & mask
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & mask)
        return (left << width) | right

    out = once(index.astype(np.uint64))
    while len(outside := np.flatnonzero(out >= n)):  # cycle-walking
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def sequences(ids: np.ndarray, at: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of sequences of each row (its end token counted), and each row's tokens."""
    n = np.diff(at) + 1
    return -(-n // stride), n


def open_folder(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def shard_name(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:08d}.bin"


def write_manifest(uri: str, about: dict) -> None:
    filesystem, folder = open_folder(uri)
    filesystem.create_dir(folder, recursive=True)
    partial = f"{folder}/manifest.json.{uuid.uuid4().hex}"
    with filesystem.open_output_stream(partial) as file:
        file.write(json.dumps(about).encode())
    filesystem.move(partial, f"{folder}/manifest.json")


def sequences_held(uri: str) -> int | None:
    """The manifest's number of sequences."""
    filesystem, folder = open_folder(uri)
    name = f"{folder}/manifest.json"
    if filesystem.get_file_info(name).size is None:
        return None
    with filesystem.open_input_file(name) as file:
        return json.loads(file.read())["sequences"]


def read_sequences(uri: str, first_slot: int, number: int, stride: int = STRIDE,
                   per_shard: int = PER_SHARD) -> Iterator[np.ndarray]:
    """Sequences (16-bit ids, padding included) from a slot on, at most ``number``; one seek a shard."""
    filesystem, folder = open_folder(uri)
    slot, record = first_slot, 2 * stride
    held = sequences_held(uri)
    if held is not None:
        number = min(number, held - first_slot)
    while slot < first_slot + number:
        name = shard_name(folder, slot // per_shard)
        if filesystem.get_file_info(name).size is None:
            return
        with filesystem.open_input_file(name) as file:
            file.seek(slot % per_shard * record)
            while slot < first_slot + number:
                raw = file.read(record)
                if len(raw) < record:
                    break
                yield np.frombuffer(raw, "<u2")
                slot += 1
                if slot % per_shard == 0:
                    break
            else:
                return
            if slot % per_shard:
                return


def holds(filesystem, name: str, wanted: list[bytes]) -> bool:
    """Whether the file is there and has these sequences, byte for byte."""
    if filesystem.get_file_info(name).size != sum(map(len, wanted)):
        return False
    with filesystem.open_input_file(name) as file:
        return all(file.read(len(x)) == x for x in wanted)


def write_shards(docs: DataFrame, ranks: str | bytes, pattern: str | None, uri: str, key: int = 1,
                 id_col: str = "doc_id", text_col: str = "text", stride: int = STRIDE,
                 per_shard: int = PER_SHARD, end_token: int = 2, pad: int = PAD) -> DataFrame:
    """slot, shard, offset (bytes), id, piece, length, ids_crc32 per sequence, the last read back
    from the shards. The shards are written when the result is computed."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def encoded(batches):
        encoder = vocabulary_encoder(ranks, pattern)
        for whole in batches:
            for batch in slices(whole, "text"):
                buf, offsets = text_buffer(batch["text"])
                ids, at = encoder.encode(buf, offsets)
                if len(ids) and int(ids.max()) > 0xFFFF:
                    raise ValueError(f"token id {int(ids.max())} does not fit the shards' 16 bits")
                yield batch, ids.astype("<u2"), at, buf, np.diff(offsets).astype("<i8")

    def chained(check, buf, sizes):  # of texts and their lengths, in order
        return zlib.crc32(buf, check[0]), zlib.crc32(sizes, check[1])

    def count(batches):
        total, check = 0, (0, 0)
        for _, ids, at, buf, sizes in encoded(batches):
            total += int(sequences(ids, at, stride)[0].sum())
            check = chained(check, buf, sizes)
        yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "n": [total],
                                          "crc": pa.array([check[0] << 31 ^ check[1]], pa.int64())})

    parts = sorted(base.mapInArrow(count, "part bigint, n bigint, crc bigint").collect())
    starts, n = {}, 0
    for part in parts:
        starts[part["part"]] = (n, part["n"], part["crc"])
        n += part["n"]
    shards = max(1, ceil(n / per_shard))
    write_manifest(uri, {"sequences": n, "key": key, "stride": stride, "per_shard": per_shard,
                         "end_token": end_token, "pad": pad,
                         "vocabulary": zlib.crc32((pattern or "").encode(), zlib.crc32(
                             ranks.encode() if isinstance(ranks, str) else ranks)),
                         "input": zlib.crc32(repr(sorted(starts.items())).encode())})

    def place(batches):
        part = TaskContext.get().partitionId()
        first, expected, crc = starts.get(part, (0, 0, 0))
        done, check = 0, (0, 0)
        for batch, ids, at, buf, sizes in encoded(batches):
            check = chained(check, buf, sizes)
            counts, lengths = sequences(ids, at, stride)
            rows = np.repeat(np.arange(len(counts)), counts)
            piece = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
            slot = feistel(first + done + np.arange(len(rows)), n, key)
            done += len(rows)
            if done > expected:
                raise RuntimeError(f"input partition {part} changed between the passes")
            size = np.minimum(lengths[rows] - piece * stride, stride)
            begin = at[rows] + piece * stride
            last = piece == counts[rows] - 1
            raw = memoryview(ids.tobytes())
            end = int(end_token).to_bytes(2, "little")
            tokens = [bytes(raw[2 * b:2 * (b + s - z)]) + end * z for b, s, z in zip(
                begin.tolist(), size.tolist(), last.astype(int).tolist(), strict=True)]
            yield pa.RecordBatch.from_pydict({
                "slot": pa.array(slot), "id": batch["id"].take(pa.array(rows, pa.int64())),
                "piece": pa.array(piece, pa.int64()), "tokens": pa.array(tokens, pa.binary())})
        if (done, check[0] << 31 ^ check[1]) != (expected, crc):
            raise RuntimeError(f"input partition {part} changed between the passes")

    def write(batches):
        filesystem, folder = open_folder(uri)
        record = 2 * stride
        filler = int(pad).to_bytes(2, "little")
        got = list(batches)
        if not got:
            return
        table = pa.Table.from_batches(got)
        slots = table["slot"].to_numpy()
        for shard in np.unique(slots // per_shard).tolist():
            rows = np.flatnonzero(slots // per_shard == shard)
            rows = rows[np.argsort(slots[rows])]
            mine = table.take(pa.array(rows))
            name = shard_name(folder, shard)
            used = [len(tokens) // 2 for tokens in mine["tokens"].to_pylist()]
            wanted = [tokens + filler * (stride - len(tokens) // 2) for tokens in mine["tokens"].to_pylist()]
            if not holds(filesystem, name, wanted):
                partial = f"{name}.{uuid.uuid4().hex}"
                filesystem.create_dir(folder, recursive=True)
                with filesystem.open_output_stream(partial) as file:
                    for sequence in wanted:
                        file.write(sequence)
                filesystem.move(partial, name)
            with filesystem.open_input_file(name) as file:
                crc = [zlib.crc32(file.read(record)[:2 * k]) for k in used]
            yield pa.RecordBatch.from_pydict({
                "slot": mine["slot"].combine_chunks(), "shard": pa.array([shard] * len(rows), pa.int64()),
                "offset": pa.array((slots[rows] - shard * per_shard) * record),
                "id": mine["id"].combine_chunks(), "piece": mine["piece"].combine_chunks(),
                "length": pa.array(used, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})

    kind = base.schema["id"].dataType.simpleString()
    placed = base.mapInArrow(place, f"slot bigint, id {kind}, piece bigint, tokens binary")
    ranged = placed.repartitionById(shards, F.floor(F.col("slot") / per_shard).cast("int"))
    return ranged.mapInArrow(write, f"slot bigint, shard bigint, offset bigint, id {kind}, piece bigint, "
                                    "length bigint, ids_crc32 bigint")
