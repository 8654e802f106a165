r"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

*Sets.* Words ``[^\x20\x09-\x0D]+`` after lower-casing A-Z; a document's set is its distinct
``shingle``-word runs (the whole sequence where it has fewer words) as 64-bit hashes.

*Sketch.* ``t = bands * rows`` coordinates. In round i < t every element falls into a hashed bin
with value i + u, u hashed in [0, 1); in round t + j all elements compete for bin j. Each bin keeps its
least value, and a document stops as soon as all its bins are filled. So every coordinate fills, equal
coordinates have probability J, and their number is concentrated as for independent ones.

*Bands.* Two sets of similarity s share one of b bands of r rows with probability 1-(1-s^r)^b. Bands and
rows follow from ``percent``, so that a link at the threshold is missed with probability below 3e-7:
32 x 6 at 85, 50 x 6 at 80. Links above it are missed more rarely still.

*Copies first.* Documents with equal sets collapse to one representative before anything pairs
up, so copies never form pairs, however many there are.

*Verification.* Buckets tie representatives into clusters (components over buckets, light rows). A
cluster of at most ``unit`` members is checked in one task on the full sets: intersection sizes are a
product of 0/1 matrices, and only a spanning forest of the true links leaves the task. Members of
larger clusters are first held against one centre; those linked to it are one class. What is left are pairs with
a stray, within reach by the triangle inequality of the Jaccard distance: they are checked bucket by bucket, each distinct
bucket once, and a bucket over ``unit`` in pairs of blocks, so no task grows with the bucket and no pair is lost.
Links pct * |union| <= 100 * |intersection| are exact on the full sets. Components over the links give the classes.

Defined results: null text or no words: empty set, linked with nothing; rows that repeat share a
class; a null id counts as the largest and its class is named by the smallest id that is not null
(null if there is none); ``kept`` is true where the id names the class (rows that repeat that id all
carry it); an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import hashlib
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import free_name, stored
from quarry.llm.graph import components
from quarry.llm.hashing import hash_ranges, lower_ascii_bytes, mix, shingles, slices, text_buffer, words

EMPTY = np.uint64(2**64 - 1)
MISS = 3e-7  # at most, of a link at the threshold


def banding(percent: int, most_rows: int = 6, most_bands: int = 64) -> tuple[int, int]:
    """(bands, rows): the longest bands of which at most ``most_bands`` keep misses below MISS; at low
    thresholds, as many bands of one row as it takes."""
    if percent <= 0:
        raise ValueError("sets of similarity 0 share no band")
    for rows in range(most_rows, 0, -1):
        miss = 1 - min(percent / 100, 1 - 1e-9) ** rows
        bands = max(1, ceil(log(MISS) / log(miss)))
        if bands <= most_bands:
            break
    return bands, rows


def document_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    buf, offsets = text_buffer(column)
    buf = lower_ascii_bytes(buf)
    starts, ends, row = words(buf, offsets)
    n_rows = len(offsets) - 1
    hashes, rows, _ = shingles(hash_ranges(buf, starts, ends), row, size, n_rows)
    order = np.argsort(rows, kind="stable")
    hashes = hashes[order]
    cut = np.searchsorted(rows[order], np.arange(n_rows + 1))
    return [np.unique(hashes[a:b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


def sketches(sets: list[np.ndarray], t: int) -> np.ndarray:
    """Fast similarity sketches, one row of ``t`` coordinates a set; empty sets stay EMPTY."""
    out = np.full((len(sets), t), EMPTY)
    flat = out.reshape(-1)
    hashes = np.concatenate([*sets, np.zeros(0, np.uint64)])
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    for i in range(2 * t):
        if not len(hashes):
            break
        x = mix(hashes ^ mix(np.array([i + 1], dtype=np.uint64)))
        bins = ((x >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64) if i < t \
            else np.full(len(x), i - t)
        value = (np.uint64(i) << np.uint64(54)) | (mix(x) >> np.uint64(10))
        np.minimum.at(flat, rows * t + bins, value)
        more = (out == EMPTY).any(axis=1)[rows]
        hashes, rows = hashes[more], rows[more]
    return out


def band_keys(sketch: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    parts = sketch.reshape(len(sketch), bands, -1)
    keys = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), parts.shape[:2]).copy()
    for k in range(parts.shape[2]):
        keys = mix(keys * np.uint64(0xA24BAED4963EE407) + parts[:, :, k])
    return keys.view(np.int64)


def set_digest(one: np.ndarray) -> bytes | None:
    return hashlib.blake2b(one.tobytes(), digest_size=16).digest() if len(one) else None


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int, bands: int,
               rows: int) -> DataFrame:
    """id, n_shingles, digest (of the set, null if empty), bands (keys; null if empty)."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                sets = document_sets(batch["text"], shingle)
                keys = band_keys(sketches(sets, bands * rows), bands)
                yield pa.RecordBatch.from_pydict({
                    "id": batch["id"], "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "digest": pa.array([set_digest(s) for s in sets], pa.binary()),
                    "bands": pa.array([k if len(s) else None for s, k in zip(sets, keys, strict=True)],
                                      pa.list_(pa.int64()))})

    kind = base.schema["id"].dataType.simpleString()
    return base.mapInArrow(run, f"id {kind}, n_shingles bigint, digest binary, bands array<bigint>")


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str,
              shingle: int) -> DataFrame:
    """(node, hashes) for ``wanted`` (node, id, digest): sets recomputed from the texts. A row counts
    only if its set has the wanted digest, so repeated ids do no harm."""
    base = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("text"))
    rows = base.join(wanted, base["__id"].eqNullSafe(wanted["id"])).select("text", "node", "digest")

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                sets = document_sets(batch["text"], shingle)
                same = [set_digest(s) == d for s, d in zip(sets, batch["digest"].to_pylist(),
                                                           strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "node": batch["node"].filter(pa.array(same, pa.bool_())),
                    "hashes": pa.array([s.tobytes() for s, ok in zip(sets, same, strict=True) if ok],
                                       pa.binary())})

    return rows.mapInArrow(run, "node bigint, hashes binary").dropDuplicates(["node"])


def spanning_links(nodes: list[int], sets: list[np.ndarray], percent: int,
                   cells: int = 1 << 22) -> list[tuple[int, int]]:
    """A spanning forest of the links among the sets, found on exact intersection sizes."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    _, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), sizes)
    shared = seen[column] > 1
    column = np.unique(column[shared], return_inverse=True)[1] if shared.any() else column[:0]
    owner = owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = np.zeros((n, n), dtype=np.float32)
    width = max(1, cells // n)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [first, first + width])
        block = np.zeros((n, width), dtype=np.float32)
        block[owner[a:b], column[a:b] - first] = 1
        common += block @ block.T
    common = common.astype(np.int64)
    linked = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    links, todo = [], np.ones(n, dtype=bool)
    for root in range(n):
        if not todo[root]:
            continue
        todo[root] = False
        front = [root]
        while front:
            at = front.pop()
            near = np.flatnonzero(linked[at] & todo)
            todo[near] = False
            links += [(nodes[at], nodes[i]) for i in near.tolist()]
            front += near.tolist()
    return links


def verify(units: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) within each unit; ``units`` has (unit, i, j, node)."""
    def run(key, table):
        del key
        nodes = table["node"].to_pylist()
        found = spanning_links(nodes, [np.frombuffer(x, np.uint64) for x in table["hashes"].to_pylist()],
                               percent)
        return pa.table({"a": pa.array([x[0] for x in found], pa.int64()),
                         "b": pa.array([x[1] for x in found], pa.int64())})

    return units.join(sets, "node").groupBy("unit", "i", "j").applyInArrow(run, "a bigint, b bigint")


def centre_distances(large: DataFrame, members: DataFrame, sets: DataFrame) -> DataFrame:
    """(label, node, centre, common, own, other) for every node of the large clusters: its set against that of the
    cluster's centre, the member that shares the most buckets with others. Exact intersection and set sizes."""
    score = members.join(large, "node").groupBy("label", "node").agg(F.sum("n").alias("score"))
    centres = stored(score.groupBy("label").agg(F.max(F.struct("score", F.col("node").alias("centre"))).alias("best"))
                     .select("label", "best.centre"), "centres")
    pairs = stored(large.join(centres, "label"), "pairs")
    heads = stored(sets.join(centres.select(F.col("centre").alias("node")).distinct(), "node").select(
        F.col("node").alias("centre"), F.col("hashes").alias("head")), "heads")
    both = stored(pairs.join(sets, "node"), "rated").join(heads, "centre")

    def run(batches):
        for batch in batches:
            own = [np.frombuffer(x, np.uint64) for x in batch["hashes"].to_pylist()]
            head = [np.frombuffer(x, np.uint64) for x in batch["head"].to_pylist()]
            common = [len(np.intersect1d(a, b, assume_unique=True)) for a, b in zip(own, head, strict=True)]
            yield pa.RecordBatch.from_pydict({
                "label": batch["label"], "node": batch["node"], "centre": batch["centre"],
                "common": pa.array(common, pa.int64()), "own": pa.array([len(a) for a in own], pa.int64()),
                "other": pa.array([len(b) for b in head], pa.int64())})

    return both.select("label", "node", "centre", "hashes", "head").mapInArrow(
        run, "label bigint, node bigint, centre bigint, common bigint, own bigint, other bigint")


def stray_blocks(members: DataFrame, rated: DataFrame, percent: int, unit: int, unit_shingles: int) -> DataFrame:
    """(unit, i, j, node): what is left to verify in the buckets of large clusters. ``rated`` has (node, linked, far): whether
    a node is linked to its cluster's centre, and its Jaccard distance from it.

    Two linked nodes are in one class already, so a bucket without strays is done. The distance is a
    metric, so a linked node can only be linked to a stray that is at most 1 - percent/100 further from the centre.
    Strays fall into blocks, linked nodes within reach into blocks of their own; a unit is a pair of blocks of
    which one has strays, so work grows with strays times members.
    """
    reach = 1 - percent / 100 + 1e-9
    here = members.join(rated, "node")
    nearest = here.filter("not linked").groupBy("key").agg(F.min("far").alias("nearest"))
    inside = stored(here.join(stored(nearest, "nearest"), "key").filter(
        ~F.col("linked") | (F.col("far") >= F.col("nearest") - reach)), "reachable")
    blocks_of = lambda n, weight: F.greatest(F.ceil(n / unit), F.ceil(weight / unit_shingles))
    only = lambda what, linked: F.sum(F.when(F.col("linked") == linked, what).otherwise(0))
    one = F.lit(1)
    sizes = inside.groupBy("key").agg(
        F.count("*").alias("n"), F.sum("size").alias("weight"), only(one, False).alias("ns"), only(one, True).alias("nl"),
        only(F.col("size"), False).alias("ws"), only(F.col("size"), True).alias("wl"))
    fits = (F.col("n") <= unit) & (F.col("weight") <= unit_shingles)
    sizes = stored(sizes.filter("n > 1").select(
        "key", F.when(fits, 1).otherwise(blocks_of(F.col("ns"), F.col("ws")) * 2).cast("int").alias("ks"),
        F.when(fits, 0).otherwise(blocks_of(F.col("nl"), F.col("wl")) * 2).cast("int").alias("kl")), "sizes")
    dealt = inside.join(sizes, "key").withColumn("own", F.when(
        F.col("linked") & (F.col("kl") > 0), F.col("ks") + F.pmod(F.xxhash64("node"), F.col("kl")))
        .otherwise(F.pmod(F.xxhash64("node"), F.col("ks"))).cast("int"))
    partners = F.when(F.col("own") < F.col("ks"), F.col("ks") + F.col("kl")).otherwise(F.col("ks"))
    return dealt.withColumn("with", F.explode(F.sequence(F.lit(0), partners - 1))).select(
        F.col("key").alias("unit"), F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "node")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 5, percent: int = 85, bands: int | None = None,
                    rows: int | None = None, unit: int = 1024,
                    unit_shingles: int = 4_000_000) -> DataFrame:
    """id, n_shingles, component_id, kept, and row (a number of the input row) per input row. Bands and
    rows are those of ``banding`` unless both are given."""
    if bands is None or rows is None:
        bands, rows = banding(percent)
    marks = stored(signatures(docs, id_col, text_col, shingle, bands, rows)
                   .withColumn("row", F.monotonically_increasing_id()), "signatures")
    some = marks.filter("n_shingles > 0")
    # a digest's representative is a row that has its least id, so that its text can be found again
    reps = stored(some.groupBy("digest").agg(
        F.min(F.struct(F.col("id").isNull().alias("no"), "id", "row")).alias("first"),
        F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands")).select(
        F.col("first.row").alias("node"), F.col("first.id").alias("id"), "digest", "n_shingles",
        "bands"), "representatives")
    # as many parts as the shuffles have, so that the counts a task combines stay few
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    keys = reps.select("node", "n_shingles", "bands").repartition(parts, "node").select(
        "node", F.col("n_shingles").alias("size"), F.explode("bands").alias("key"))
    # counts combine map-side and are written, so the join back is one that Spark splits at a hot band key
    often = stored(keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "often")
    held = stored(keys.join(often, "key"), "held")
    told = stored(held.groupBy("key").agg(
        F.min("node").alias("least"), F.sum("size").alias("weight"), F.bit_xor(F.xxhash64("node")).alias("x"),
        F.sum(F.xxhash64(F.lit(1), "node").bitwiseAND(F.lit((1 << 40) - 1))).alias("s")), "told")
    shared = stored(held.join(told, "key"), "buckets")
    # bands that hold the same members say the same
    one_of_each = shared.groupBy("n", "x", "s").agg(F.min("key").alias("key")).select("key")
    members = stored(shared.join(one_of_each, "key", "left_semi")
                     .select("key", "node", "least", "n", "weight", "size"), "members")
    clusters = components(members.select(F.col("node").alias("a"), F.col("least").alias("b")))
    sized = clusters.join(reps.select("node", "n_shingles"), "node").groupBy("label").agg(
        F.count("*").alias("n"), F.sum("n_shingles").alias("weight"))
    small = (F.col("n") <= unit) & (F.col("weight") <= unit_shingles)
    placed = stored(clusters.join(sized, "label").withColumn("small", small), "clusters")
    by_cluster = placed.filter("small").select(
        F.col("label").alias("unit"), F.lit(0).alias("i"), F.lit(0).alias("j"), "node")
    sets = stored(full_sets(docs, reps.join(placed.select("node"), "node").select("node", "id", "digest"),
                            id_col, text_col, shingle), "sets")
    large = placed.filter("not small").select("label", "node")
    union = F.col("own") + F.col("other") - F.col("common")
    rated = stored(centre_distances(large, members, sets).select(
        "node", "centre", (100 * F.col("common") >= percent * union).alias("linked"),
        (1 - F.col("common") / union).alias("far")), "distances")
    by_bucket = stray_blocks(members, rated.select("node", "linked", "far"), percent, unit, unit_shingles)
    links = verify(by_cluster.unionByName(by_bucket), sets, percent).unionByName(
        rated.filter("linked and node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")))
    classes = components(links)
    named = reps.select("node", "id", "digest").join(classes, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    names = named.groupBy("label").agg(F.min("id").alias("component_id"))
    decided = marks.select("id", "n_shingles", "digest", "row").filter("n_shingles > 0").join(
        named.join(names, "label").select("digest", "component_id"), "digest")
    alone = marks.filter("n_shingles = 0").select("id", "n_shingles", "digest", "row",
                                                  F.col("id").alias("component_id"))
    return decided.unionByName(alone).select(
        "id", "n_shingles", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull())
        .alias("kept"), "digest")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     **options) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, all columns unchanged. Rows that repeat an
    id go only if every one of them is dropped."""
    decided = near_duplicates(docs, id_col, text_col, **options)
    mine = free_name(docs.columns, "dropped_id")
    dropped = decided.groupBy(F.col("id").alias(mine)).agg(F.bool_or("kept").alias("any_kept")) \
        .filter("not any_kept").select(mine)
    return docs.join(dropped, docs[id_col].eqNullSafe(F.col(mine)), "left_anti")
