r"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

*Byte-to-character mapping.* Byte-level BPE writes each byte as one printable character; the
tokenizer's vocabulary is in those characters. ``byte_table`` is that mapping, and decoding
reverses it: token -> characters -> bytes, joined over the whole sequence before UTF-8 is read, so
characters that were split over several tokens come back whole.

*Rank files.* ``from_ranks`` turns a rank file (base64 token, rank) into a tokenizers model whose
merges, ordered by rank, are all splits of each token into two known tokens. Matches that are
tokens as a whole are taken directly (``ignore_merges``), as rank encoders do.

*Words are encoded once.* The split pattern never joins a non-space character with a following
space, so a text falls apart at single spaces (and single line breaks) into words that can be
encoded alone. ``WordEncoder`` hashes the words of a batch, sends those it has not met to the
library and keeps their ids in a cache of at most ``cache_words`` entries, shared by the tasks of
a Python worker. Memory is bounded by that and by one slice of a batch; nothing is shuffled.

Defined results: a null text counts as empty (no tokens); rows keep their multiplicity and order;
null ids stay; other columns are not read unless named in ``keep``; an empty table gives an empty
result; strings of special tokens in a text are ordinary text.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.hashing import gather, hash_ranges, slices, text_buffer

ASCII_BLANK = np.zeros(256, dtype=bool)
ASCII_BLANK[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
LEAD = np.zeros(256, dtype=bool)
LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True  # first bytes of blanks beyond ASCII
OTHER_BLANK = re.compile(rb"[\x09-\x0D\x1C-\x20\xC2\xE1-\xE3]")
CACHE_WORDS = 1_500_000


@functools.cache
def byte_table() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1 stands for itself,
    the others take the code points from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def from_ranks(path: str, pattern: str) -> str:
    """The tokenizers JSON of the byte-level model that a rank file and a split pattern define."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers
    table = byte_table()
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    shown = {token: "".join(table[b] for b in token) for token in ranks}
    merges = [(shown[token[:cut]], shown[token[cut:]])
              for token, _ in sorted(ranks.items(), key=lambda x: x[1])
              for cut in range(1, len(token)) if token[:cut] in ranks and token[cut:] in ranks]
    tokenizer = Tokenizer(models.BPE(vocab={shown[t]: r for t, r in ranks.items()}, merges=merges,
                                     ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return tokenizer.to_str()


def from_json(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


@functools.lru_cache(maxsize=4)
def tokenizer_of(spec: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_str(spec)
    tokenizer.encode_special_tokens = True
    return tokenizer


@functools.lru_cache(maxsize=4)
def byte_arena(spec: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place and length of each token id's bytes in an arena, and the arena."""
    back = {c: b for b, c in enumerate(byte_table())}
    model = json.loads(spec)
    special = {x["id"]: x["content"].encode() for x in model.get("added_tokens", [])}
    table = {i: bytes(back[c] for c in token) for token, i in model["model"]["vocab"].items()
             if i not in special} | special
    known = [table.get(i, b"") for i in range(max(table) + 1)]
    sizes = np.array([len(x) for x in known], dtype=np.int64)
    return np.cumsum(sizes) - sizes, sizes, np.frombuffer(b"".join(known), dtype=np.uint8)


def cuts(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the parts of the rows that encode alone.

    The split pattern never takes a non-space character and a following space into one match, so
    a part may start at a single space, and a single line break is a part of its own - as
    long as no other blank stands beside them. Bytes that may belong to a blank beyond ASCII
    count as one.
    """
    edge = np.zeros(len(buf) + 1, dtype=bool)
    edge[offsets] = True
    if not len(buf):
        return np.flatnonzero(edge[:-1])
    blank = ASCII_BLANK[buf]
    ends_blank = blank.copy()
    ends_blank[1:] |= buf[:-1] == 0xC2
    ends_blank[2:] |= (buf[:-2] >= 0xE1) & (buf[:-2] <= 0xE3)
    lone = np.zeros(len(buf), dtype=bool)
    lone[1:-1] = ~ends_blank[:-2] & ~(blank | LEAD[buf])[2:]
    lone &= ~edge[:-1] & ~edge[1:]
    line = lone & (buf == 10)
    edge[:-1] |= line | lone & (buf == 32)
    edge[1:] |= line
    return np.flatnonzero(edge[:-1])


class WordEncoder:
    """Encodes the rows of a text column, meeting each distinct word once.

    Known words are arrays of at most ``cache_words`` entries: hash, and place and number of ids in
    an arena. Decoding shows any clash of two words' 64-bit hashes (``exact`` below).
    """

    def __init__(self, encode_text, cache_words: int = CACHE_WORDS):
        self.encode_text, self.cache_words = encode_text, cache_words
        self.line_break = encode_text("\n")
        self.clear()

    def clear(self) -> None:
        self.keys, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.n, self.arena, self.used = np.zeros(0, np.int64), np.zeros(1 << 16, np.uint32), 0

    def add(self, ids: np.ndarray) -> int:
        while self.used + len(ids) > len(self.arena):
            self.arena = np.concatenate([self.arena, np.zeros_like(self.arena)])
        self.arena[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        return self.used - len(ids)

    def learn(self, keys: np.ndarray, found: list[bytes]) -> None:
        """Encode new words: plain ones many at a time, a line break between them."""
        at, n = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        plain = [i for i, w in enumerate(found) if w.strip(b" ") and not OTHER_BLANK.search(w, 1)
                 and (w[0] == 32 or not OTHER_BLANK.match(w))] if len(self.line_break) == 1 else []
        for k in range(0, len(plain), 2048):
            part = plain[k:k + 2048]
            ids = np.asarray(self.encode_text(b"\n".join([found[i] for i in part]).decode()),
                             dtype=np.uint32)
            cut = np.flatnonzero(ids == self.line_break[0])
            begin = np.concatenate([[0], cut + 1])
            at[part] = self.add(ids) + begin
            n[part] = np.concatenate([cut, [len(ids)]]) - begin
        for i in set(range(len(keys))).difference(plain):
            ids = np.asarray(self.encode_text(found[i].decode()), dtype=np.uint32)
            at[i], n[i] = self.add(ids), len(ids)
        where = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, where, keys)
        self.at, self.n = np.insert(self.at, where, at), np.insert(self.n, where, n)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        where = np.searchsorted(self.keys, keys)
        held = np.zeros(len(keys), dtype=bool)
        inside = where < len(self.keys)
        held[inside] = self.keys[where[inside]] == keys[inside]
        return where, held

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, and the n+1 offsets of the rows in them."""
        starts = cuts(buf, offsets)
        ends = np.concatenate([starts[1:], [len(buf)]]) if len(starts) else starts
        keys, first, back = np.unique(hash_ranges(buf, starts, ends), return_index=True,
                                      return_inverse=True)
        if len(self.keys) + len(keys) > self.cache_words:
            self.clear()
        _, held = self.find(keys)
        new = first[~held]
        if len(new):
            raw = buf.tobytes()
            self.learn(keys[~held], [raw[a:b] for a, b in zip(
                starts[new].tolist(), ends[new].tolist(), strict=True)])
        where, _ = self.find(keys)
        n = self.n[where][back]
        ids = gather(self.arena, self.at[where][back], n)
        total = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
        return ids, total[np.searchsorted(starts, offsets)]


def tokenizers_encoder(spec: str):
    tokenizer = tokenizer_of(spec)
    return lambda text: tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids


@functools.lru_cache(maxsize=4)
def encoder_of(spec: str, cache_words: int = CACHE_WORDS) -> WordEncoder:
    """One encoder a Python worker, shared by its tasks."""
    return WordEncoder(tokenizers_encoder(spec), cache_words)


def character_spans(raw: np.ndarray, ids: np.ndarray,
                    sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character start and end of each token of one text, from the tokens' byte lengths."""
    if not len(ids):
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    char_at = np.cumsum((raw & 0xC0) != 0x80) - 1  # the character to which each byte belongs
    ends = np.cumsum(sizes[ids])
    starts = ends - sizes[ids]
    return char_at[starts].astype(np.int32), (char_at[ends - 1] + 1).astype(np.int32)


def encode(docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text",
           keep: tuple[str, ...] = (), offsets: bool = False) -> DataFrame:
    """id, n_tokens, ids (binary, little-endian unsigned 32-bit) per row, and the ``keep`` columns.

    With ``offsets``, also ``starts`` and ``ends``: each token's character range in the text; the
    tokens of a split character share that character's range.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                       *[F.col(k) for k in keep])

    def run(batches):
        encoder = encoder_of(spec)
        for whole in batches:
            for batch in slices(whole, "text"):
                buf, rows = text_buffer(batch["text"])
                ids, at = encoder.encode(buf, rows)
                parts = np.split(ids.astype("<u4"), at[1:-1])
                columns = {name: batch[name] for name in batch.schema.names if name != "text"}
                columns["n_tokens"] = pa.array(np.diff(at), pa.int64())
                columns["ids"] = pa.array([x.tobytes() for x in parts], pa.binary())
                if offsets:
                    spans = [character_spans(buf[a:b], x, byte_arena(spec)[1])
                             for a, b, x in zip(rows, rows[1:], parts, strict=False)]
                    columns["starts"] = pa.array([s[0] for s in spans], pa.list_(pa.int32()))
                    columns["ends"] = pa.array([s[1] for s in spans], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema
                        if f.name != "text"])
    more = ", starts array<int>, ends array<int>" if offsets else ""
    return base.mapInArrow(run, f"{fields}, n_tokens bigint, ids binary{more}")


def decode_bytes(ids: np.ndarray, spec: str) -> np.ndarray:
    starts, sizes, arena = byte_arena(spec)
    return gather(arena, starts[ids], sizes[ids])


def decode(encoded: DataFrame, spec: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded`` (binary: the exact bytes) in place of the ids.

    Bytes, not text: a sequence cut inside a character has bytes that are no UTF-8.
    """
    kept = [f for f in encoded.schema if f.name != ids_col]

    def run(batches):
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                batch = whole.slice(k, 256)
                columns = {f.name: batch[f.name] for f in kept}
                columns["decoded"] = pa.array([None if x is None else decode_bytes(
                    np.frombuffer(x, "<u4"), spec).tobytes() for x in batch[ids_col].to_pylist()],
                    pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return encoded.mapInArrow(run, f"{fields}, decoded binary")


def sha256_of_ranges(data: memoryview, offsets: np.ndarray) -> list[str]:
    return [hashlib.sha256(data[a:b]).hexdigest()
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def round_trip_digests(docs: DataFrame, spec: str, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256, exact: encode, decode and digest in one pass, so
    that the ids of a large table need not leave the Python worker."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        encoder = encoder_of(spec)
        sizes = byte_arena(spec)[1]
        for whole in batches:
            for batch in slices(whole, "text"):
                buf, rows = text_buffer(batch["text"])
                ids, at = encoder.encode(buf, rows)
                back = decode_bytes(ids, spec)
                ends = np.concatenate([[0], np.cumsum(sizes[ids])]).astype(np.int64)[at]
                yield pa.RecordBatch.from_pydict({
                    "id": batch["id"], "n_tokens": pa.array(np.diff(at), pa.int64()),
                    "ids_sha256": pa.array(sha256_of_ranges(
                        memoryview(ids.astype("<u4").tobytes()), at * 4), pa.string()),
                    "decoded_sha256": pa.array(sha256_of_ranges(
                        memoryview(back.tobytes()), ends), pa.string()),
                    "exact": pa.array([np.array_equal(buf[a:b], back[c:d]) for a, b, c, d in zip(
                        rows, rows[1:], ends, ends[1:], strict=False)], pa.bool_())})

    kind = base.schema["id"].dataType.simpleString()
    return base.mapInArrow(run, f"id {kind}, n_tokens bigint, ids_sha256 string, "
                                "decoded_sha256 string, exact boolean")
