"""Encoding, packing and shards."""

import base64
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import bpe, packing, shards
from quarry.llm.hashing import slices, text_buffer
from quarry.llm.queries import gpt_ranks

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def rank_library(path):
    with open(path, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


@pytest.fixture(scope="module")
def spec():
    return bpe.from_ranks(MULTI, public_tokenizers.PATTERN)


def encode_all(encoder, texts):
    out = []
    for batch in slices(pa.RecordBatch.from_pydict({"t": texts}), "t", 5000):
        ids, at = encoder.encode(*text_buffer(batch["t"]))
        out += [x.tolist() for x in np.split(ids, at[1:-1])]
    return out


def odd_texts(number):
    rng = random.Random(2)
    parts = ["a", "aa", "b", " ", "  ", "\n", "\t", "1", "é", "漢", "🙂", "'s", "...", " ", "　", "\x1c",
             "\x85", " ", "​", "\r\n", "the", "\0", "Ⅷ", "<|endoftext|>", " \n", "ab", "x"]
    return ["".join(rng.choice(parts) * rng.choice([1, 1, 1, 2, 3, 9]) for _ in range(rng.randint(0, 14)))
            for _ in range(number)]


def test_encoder_equals_the_rank_library(spec, medium_rows):
    library = rank_library(MULTI)
    texts = odd_texts(4000) + [t for _, t in medium_rows]
    got = encode_all(bpe.WordEncoder(bpe.tokenizers_encoder(spec), 500), texts)  # a cache that overflows
    assert got == [library.encode_ordinary(t) for t in texts]


def test_gpt_ranks_equal_the_tokenizers_model(medium_rows):
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    model.encode_special_tokens = True
    texts = odd_texts(3000) + [t for _, t in medium_rows[:60]]
    got = encode_all(packing.rank_encoder(*gpt_ranks()), texts)
    assert got == [x.ids for x in model.encode_batch(texts, add_special_tokens=False)]


def test_digests_and_decoding_on_edges(spec, edge_docs, edge_rows, no_docs):
    import hashlib
    library = rank_library(MULTI)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = Counter()
    for i, t in edge_rows:
        ids = library.encode_ordinary(t or "")
        want[(i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((t or "").encode()), True)] += 1
    got = Counter(tuple(r) for r in bpe.round_trip_digests(edge_docs, spec).collect())
    assert got == want
    assert bpe.round_trip_digests(no_docs, spec).count() == 0
    back = bpe.decode(bpe.encode(edge_docs, spec, keep=("kept",)), spec).collect()
    assert Counter((r.id, bytes(r.decoded), r.kept) for r in back) == Counter(
        (i, (t or "").encode(), "k") for i, t in edge_rows)


def test_offsets_cover_the_text_and_split_characters(spec, spark):
    texts = ["漢字🙂 x", "plain words here", "é" * 5, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    split = 0
    for r in bpe.encode(docs, spec, offsets=True).collect():
        text, ids = texts[r.id], np.frombuffer(r.ids, "<u4")
        covered = set()
        for a, b, i in zip(r.starts, r.ends, ids, strict=True):
            token = bpe.decode_bytes(np.array([i]), spec).tobytes()
            assert token in text[a:b].encode()
            split += token != text[a:b].encode()
            covered |= set(range(a, b))
        assert covered == set(range(len(text)))
    assert split  # some tokens end inside a character


def best_possible(lengths, capacity):
    """Fewest bins by exhaustive search, for few items."""
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= lengths[i] and rooms[k] not in rooms[:k]:
                place(i + 1, [*rooms[:k], rooms[k] - lengths[i], *rooms[k + 1:]])
        place(i + 1, [*rooms, capacity - lengths[i]])
    place(0, [])
    return best


def test_bounds_never_exceed_the_optimum():
    rng = random.Random(1)
    for _ in range(150):
        lengths = np.array([rng.randint(1, 30) for _ in range(rng.randint(1, 9))])
        best = best_possible(lengths.tolist(), 30)
        bins, offsets, used = packing.best_fit_decreasing(lengths, 30)
        assert packing.lower_bound(lengths, 30) <= best <= used
        for b in range(used):
            mine = sorted((o, n) for o, n, c in zip(offsets, lengths, bins, strict=True) if c == b)
            assert [o for o, _ in mine] == [sum(n for _, n in mine[:k]) for k in range(len(mine))]
            assert sum(n for _, n in mine) <= 30


def test_packing_on_edges(edge_docs, edge_rows, no_docs, spark):
    library = rank_library(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    want = Counter()
    for i, t in edge_rows:
        ids = [*library.encode_ordinary(t or ""), 2]
        first = len(ids) % 1024 or 1024
        for piece, start in enumerate([0, *range(first, len(ids), 1024)]):
            part = ids[start:first if not piece else start + 1024]
            want[(i, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    for per_partition in (60_000, 5):  # 5: many partitions that exchange
        got = packing.pack_documents(edge_docs, *gpt_ranks(), per_partition=per_partition).collect()
        assert Counter((r.id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
        held = defaultdict(list)
        for r in got:
            held[r.sequence_id].append((r.offset, r.length))
        for spans in held.values():
            spans.sort()
            assert [a for a, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))]
            assert sum(n for _, n in spans) <= 1024
        bound = -(-sum(r.length for r in got) // 1024)
        assert len(held) <= bound + 1
    assert packing.pack_documents(no_docs, *gpt_ranks()).count() == 0


@pytest.mark.parametrize("max_rounds", [1, 3])
def test_partitions_with_gaps_share_their_remainders(spark, max_rounds):
    lengths = [30] * 1200  # three fill a sequence of 100, whatever the partition
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "id bigint, length bigint")
    got = packing.pack(pieces, 100, per_partition=20, max_rounds=max_rounds).collect()
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    assert sorted(r.id for r in got) == list(range(1200))
    for spans in held.values():
        spans.sort()
        assert [a for a, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))]
        assert sum(n for _, n in spans) <= 100
    assert len(held) <= 401


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_feistel_is_a_keyed_bijection(n):
    one, two = (shards.feistel(np.arange(n), n, key) for key in (1, 2))
    assert sorted(one.tolist()) == sorted(two.tolist()) == list(range(n))
    assert n < 17 or (one != two).any()


def test_shards_hold_every_token_in_slot_order(edge_docs, edge_rows, no_docs, tmp_path):
    library = rank_library(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    folder = str(tmp_path / "out")
    rows = shards.write_shards(edge_docs, *gpt_ranks(), folder, stride=64, per_shard=50).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    stored = list(shards.read_sequences(folder, 0, 10**6, stride=64, per_shard=50))
    assert len(stored) == len(rows)
    assert [x.tobytes() for x in shards.read_sequences(folder, 45, 70, stride=64, per_shard=50)] == [
        x.tobytes() for x in stored[45:115]]
    texts = Counter()
    parts = defaultdict(list)
    for r in rows:
        used = stored[r.slot][:r.length]
        assert zlib.crc32(used.tobytes()) == r.ids_crc32 and (r.shard, r.offset) == (
            r.slot // 50, r.slot % 50 * 128)
        parts[(r.id, r.piece)].append(tuple(used.tolist()))
    for i, t in edge_rows:
        ids = [*library.encode_ordinary(t or ""), 2]
        texts.update((i, k, tuple(ids[64 * k:64 * k + 64])) for k in range(-(-len(ids) // 64)))
    assert Counter((i, k, x) for (i, k), xs in parts.items() for x in xs) == texts
    again = shards.write_shards(edge_docs, *gpt_ranks(), folder, stride=64, per_shard=50)  # resumes
    assert sorted(r.slot for r in again.collect()) == list(range(len(rows)))
    assert shards.write_shards(no_docs, *gpt_ranks(), str(tmp_path / "none")).count() == 0


def test_shards_of_a_changed_input_replace_the_old_ones(spark, tmp_path):
    folder = str(tmp_path / "out")

    def written(texts, **options):
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
        rows = shards.write_shards(docs, *gpt_ranks(), folder, stride=8, per_shard=10, **options).collect()
        held = list(shards.read_sequences(folder, 0, 10**6, stride=8, per_shard=10))
        assert len(held) == len(rows)
        return {r.id: (held[r.slot][:r.length].tolist(), r.ids_crc32) for r in rows}

    library = rank_library(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for texts, options in ((["the cat"] * 40, {}), (["the dog"] * 40, {}), (["the dog"] * 20, {}),
                           ([f"the {w}" for w in ["dog", "cat"] * 10], {"key": 2}),
                           (["the! dog!"] * 20, {"pad": 0})):  # 0 is "!"
        got = written(texts, **options)
        for i, text in enumerate(texts):
            ids = [*library.encode_ordinary(text), 2]
            assert got[i] == (ids, zlib.crc32(np.array(ids, "<u2").tobytes()))


def test_packing_and_shards_take_the_tokenizers_model(spark, edge_docs, tmp_path):
    from quarry.llm.queries import gpt_model
    a = packing.pack_documents(edge_docs, *gpt_model()).drop("sequence_id", "offset").collect()
    b = packing.pack_documents(edge_docs, *gpt_ranks()).drop("sequence_id", "offset").collect()
    assert Counter(map(tuple, a)) == Counter(map(tuple, b))
    rows = shards.write_shards(edge_docs, *gpt_model(), str(tmp_path / "s"), stride=64, per_shard=50)
    assert rows.agg(F.sum("length")).first()[0] == sum(r.length for r in a)


def test_shards_refuse_ids_over_16_bits(spark, edge_docs, tmp_path, monkeypatch):
    import json

    from quarry.llm.queries import gpt_model
    spec, _ = gpt_model()
    model = json.loads(spec)
    model["model"]["vocab"]["t"] = 70_000  # "t" alone gets an id beyond 16 bits
    docs = spark.createDataFrame([(1, "t t t")], "doc_id bigint, text string")
    with pytest.raises(Exception, match="16 bits"):
        shards.write_shards(docs, json.dumps(model), None, str(tmp_path / "x")).collect()
