"""Near duplicates, passages, licences, toxicity and the pipeline, against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import graph, license, minhash, packing, suffix, toxicity

from .test_native import LOWER, WORD


def shingle_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute_classes(rows, percent=85):
    """Smallest id reachable, for every row."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and min(len(sets[a]), len(sets[b])) * 100 >= percent * max(
                    len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        root = find(k)
        if i is not None:
            least[root] = min(least.get(root, i), i)
    return [(i, len(sets[k]), least.get(find(k)) if sets[k] else i) for k, (i, _) in enumerate(rows)]


def near_rows():
    rng = random.Random(9)
    words = ["w%d" % i for i in range(800)]
    rows, base = [], [rng.choice(words) for _ in range(150)]
    for i in range(60):  # near copies of one text, chains among them
        copy = list(base)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(150)] = rng.choice(words)
        rows.append((100 - i, " ".join(copy).upper() if i % 7 == 0 else " ".join(copy)))
    for i in range(60):
        rows.append((200 + i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 60)))))
    return rows + rows[3:6]


@pytest.mark.parametrize("limits", [{}, {"unit": 4}])
def test_near_duplicates_equal_brute_force(spark, edge_docs, edge_rows, limits):
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    for frame, given in ((docs, rows), (edge_docs, edge_rows)):
        got = minhash.near_duplicates(frame, **limits).collect()
        assert Counter((r.id, r.n_shingles, r.component_id) for r in got) == Counter(brute_classes(given))
        assert all(r.kept == (r.id == r.component_id) for r in got if r.id is not None)


def test_near_duplicates_filter_keeps_columns(edge_docs, no_docs):
    kept = minhash.keep_one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    assert minhash.near_duplicates(no_docs).count() == 0 == minhash.keep_one_of_each(no_docs).count()


@pytest.mark.parametrize("percent", [60, 70, 80])
def test_links_at_lower_thresholds_are_not_missed(spark, percent):
    rng = random.Random(percent)
    word = lambda: "w%d" % rng.randrange(10**9)
    rows = []
    for i in range(800):  # pairs with a similarity just over the threshold
        n, k = 100, 1
        while 100 * (n - k - 1) >= percent * (n + k + 1):
            k += 1
        base = [word() for _ in range(n + 4)]
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(base[:n + 4 - k] + [word() for _ in range(k)]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = minhash.keep_one_of_each(docs, percent=percent).select("doc_id").collect()
    assert {r.doc_id for r in kept} == set(range(0, 1600, 2))


def test_banding_follows_the_threshold():
    assert minhash.banding(85) == (32, 6)
    for percent in range(1, 101):
        bands, rows = minhash.banding(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= 3e-7


def test_sketches_fill_and_estimate(spark):
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    sets = [np.unique(pool[:2000]), np.unique(pool[500:2500]), np.unique(pool[:1]), np.unique(pool[:7])]
    sketch = minhash.sketches(sets, 192)
    assert (sketch != minhash.EMPTY).all()
    assert abs((sketch[0] == sketch[1]).mean() - 0.6) < 0.12
    assert 1 - (1 - 0.85**6)**32 > 1 - 3e-7


def test_components_of_a_long_chain(spark):
    n = 300
    order = list(range(n))
    random.Random(4).shuffle(order)
    edges = [(order[i], order[i + 1]) for i in range(n - 1) if i % 100 != 99]
    got = {r.node: r.label for r in graph.components(
        spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    for k in range(0, n, 100):
        part = order[k:k + 100]
        assert {got[x] for x in part} == {min(part)}


def brute_cut(rows, length):
    """(id, text) without the bytes that a repeated string of ``length`` bytes covers."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[p:p + length] for _, b in texts for p in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        keep = np.ones(len(b), dtype=bool)
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                keep[p:p + length] = False
        # a character goes whole if a byte of it goes
        out.append((i, bytes(np.frombuffer(b, np.uint8)[keep]).decode(errors="ignore")))
    return out


def gpt_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer
    if "model" not in gpt_ids.__dict__:
        gpt_ids.model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        gpt_ids.model.encode_special_tokens = True
    return gpt_ids.model.encode(text, add_special_tokens=False).ids


def brute_removal(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[p:p + length] for _, b in texts for p in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = np.zeros(len(b) + 2, dtype=int)
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p] += 1
                gone[p + length] -= 1
        mask = np.cumsum(gone)[:len(b)] > 0
        starts = np.flatnonzero(mask & ~np.concatenate([[False], mask[:-1]])) if len(b) else []
        kept = bytes(np.frombuffer(b, np.uint8)[~mask])
        out.append((i, len(b), int(mask.sum()), len(starts), hashlib.sha256(kept).hexdigest()))
    return out


def passage_rows():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghié") for _ in range(rng.randint(2, 8))) for _ in range(900)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages, long = [prose(90) for _ in range(4)], prose(400)
    rows = []
    for i in range(120):
        text = prose(rng.randint(5, 100))
        if i % 2:
            text += passages[0] + prose(rng.randint(0, 9))
        if i % 5 == 0:
            text = rng.choice(passages) + text
        if i % 9 == 0:
            text = "ab " * rng.randint(130, 300) + text
        if i % 11 == 0:
            text = long[:rng.randint(400, len(long))][rng.randint(0, 300):] + text
        rows.append((i, rows[-1][1] if i % 13 == 12 else text))
    return rows


@pytest.mark.parametrize("options", [{}, {"hot": 4}, {"bucket_bytes": 20_000}])
def test_passages_equal_brute_force(spark, options):
    rows = passage_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = suffix.removal_report(docs, **options).collect()
    assert Counter(map(tuple, got)) == Counter(brute_removal(rows, 400))


def test_passages_on_edges(edge_docs, edge_rows, no_docs):
    got = suffix.removal_report(edge_docs).collect()
    want = brute_removal(edge_rows, 400)
    assert Counter(map(tuple, got)) == Counter(want)
    cut = suffix.remove_repeats(edge_docs)
    assert cut.columns == edge_docs.columns
    assert sum(r.text is None for r in cut.collect()) == sum(t is None for _, t in edge_rows)
    assert suffix.removal_report(no_docs).count() == 0 == suffix.remove_repeats(no_docs).count()


def test_window_runs_do_not_depend_on_the_slice():
    rng = np.random.default_rng(1)
    buf = rng.integers(97, 101, 30_000).astype(np.uint8)
    offsets = np.array([0, 10_000, 10_000, 30_000])
    whole = suffix.window_runs(buf, offsets, 400, 64)
    alone = suffix.window_runs(buf[10_000:], np.array([0, 20_000]), 400, 64)
    mine = whole[0] == 2
    assert all((a[mine] - (10_000 if k in (1, 2, 3) else 0) == b).all()
               for k, (a, b) in enumerate(zip(whole, alone, strict=True)) if k)
    covered = sum(b - a + 1 for a, b in zip(whole[2], whole[3], strict=True))
    assert covered == 10_000 - 399 + 20_000 - 399


def test_multikey_sort_orders_and_measures():
    rng = random.Random(6)
    rows = sorted({bytes(rng.choice(b"ab") for _ in range(24)) for _ in range(400)})
    mixed = rows + rows[:30]
    rng.shuffle(mixed)
    table = np.frombuffer(b"".join(mixed), np.uint8).reshape(-1, 24)
    order, common = suffix.multikey_sort(np.ascontiguousarray(table).view(">u8").astype(np.uint64))
    got = [mixed[i] for i in order]
    assert got == sorted(mixed)
    for a, b, n in zip(got, got[1:], common[1:], strict=False):
        assert n == next((k for k in range(24) if a[k] != b[k]), 24)


def test_license_scan_equals_brute_force(spark, edge_docs, no_docs, medium_rows):
    gpl = license.TEMPLATES["GPL-3.0 notice"]
    cut = " ".join(gpl.split()[4:])
    rows = medium_rows + [(-1, "x " * 50 + gpl.upper() + " y" * 40), (-2, cut), (-3, gpl[:60]), (-4, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.id, r.license): (r.n_windows, r.shared, r.template_shingles)
           for r in license.scan(docs).collect()}
    want = {}
    for name, text in license.TEMPLATES.items():
        words = WORD.findall(text.translate(LOWER))
        grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        scale = 1 << math.ceil(math.log2(len(grams)))
        for i, t in rows:
            own = WORD.findall((t or "").translate(LOWER))
            at = [tuple(own[p:p + 5]) for p in range(len(own) - 4)]
            held = [len(set(grams) & set(at[k * scale:(k + 2) * scale]))
                    for k in range(-(-len(at) // scale))]
            held = [h for h in held if 100 * h >= 80 * len(set(grams))]
            if held:
                want[(i, name)] = (len(held), max(held), len(set(grams)))
    assert got == want and (-1, "GPL-3.0 notice") in got and (-2, "GPL-3.0 notice") in got
    assert license.scan(no_docs).count() == 0
    assert {r.license for r in license.scan(edge_docs).collect()} == {"MIT"}


def test_license_texts_are_found_in_comments(spark):
    known = license.full_templates()
    rng = random.Random(12)
    prose = lambda n: " ".join("w%d" % rng.randrange(500) for _ in range(n))
    marks = {"": "{}", "#": "# {}", "//": "//{}", "*": " * {}", "quoted": "> \u201c{}\u201d"}
    rows, want = [], {}
    for name, text in known.items():
        lines = [" ".join(text.split()[k:k + 9]) for k in range(0, len(text.split()), 9)]
        for mark in marks.values():
            want[len(rows)] = name
            rows.append((len(rows), prose(30) + "\n" + "\n".join(map(mark.format, lines)) + "\n" + prose(40)))
    rows += [(-1, prose(9) + " released under the MIT License and so on"), (-2, prose(300)), (-3, None)]
    got = defaultdict(set)
    for r in license.scan(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8),
                          templates=known, bare=True).collect():
        got[r.id].add(r.license)
    assert {i: name for i, name in want.items() if name not in got[i]} == {}
    for i, name in want.items():  # versions of one notice are told apart
        if "GPL" in name and name.endswith("notice"):
            assert got[i] == {name}
    assert got[-1] == {"MIT"} and not got.keys() & {-2, -3}


def labelled(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    insults = ["grumphead", "snotling", "dolt", "oafish"]
    rows, labels = [], []
    for i in range(3000):
        toxic = i % 10 == 0
        text = [rng.choice(words) for _ in range(rng.randint(20, 80))]
        for _ in range(rng.randint(2, 5) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(insults) + rng.choice(["", "s", "ing"]))
        rows.append((i, " ".join(text)))
        if i % 2 == 0:
            labels.append((i, int(toxic or rng.random() < 0.03)))
    return (spark.createDataFrame(rows, "doc_id bigint, text string"),
            spark.createDataFrame(labels, "doc_id bigint, toxic int"))


def test_toxicity_learns_from_positives_and_unlabelled(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels)
    got = {r.id: r for r in toxicity.score(docs, model).collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 3 == 1]
    hits = [got[i].predicted for i in held if i % 10 == 0]
    alarms = [got[i].predicted for i in held if i % 10]
    assert np.mean(hits) > 0.95 and np.mean(alarms) < 0.01
    kept = toxicity.keep_clean(docs, labels)
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}


@pytest.mark.parametrize("share, number", [(0.35, 4), (0.35, 200), (0.2, 200)])
def test_toxicity_finds_frequent_classes_and_rare_insults(spark, share, number):
    rng = random.Random(21)
    letters = lambda of, a, b: "".join(rng.choice(of) for _ in range(rng.randint(a, b)))
    words = [letters("abcdefghijklmnop", 2, 9) for _ in range(3000)]
    insults = [letters("qrstuvwxyz", 5, 9) for _ in range(number)]
    rows, labels = [], []
    for i in range(12_000):
        text = [rng.choice(words) for _ in range(rng.randint(20, 60))]
        toxic = rng.random() < share
        for _ in range(3 if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(insults))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    given = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    kept = {r.doc_id for r in toxicity.keep_clean(docs, given).select("doc_id").collect()}
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([i not in kept for i, y in held if y]) > 0.9
    assert np.mean([i not in kept for i, y in held if not y]) < 0.01


def test_toxicity_never_reads_held_out_labels(spark):
    docs, labels = labelled(spark)
    fold = toxicity.training_fold("doc_id")
    flipped = labels.withColumn("toxic", F.when(fold, F.col("toxic")).otherwise(1 - F.col("toxic")))
    assert np.array_equal(toxicity.fit(docs, labels), toxicity.fit(docs, flipped))


def test_toxicity_on_edges(spark, edge_docs, edge_rows, no_docs):
    docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels)
    got = toxicity.score(edge_docs, model).collect()
    assert Counter(r.id for r in got) == Counter(i for i, _ in edge_rows)
    bias = 1 / (1 + np.exp(-model[-1]))
    assert all(0 <= r.score <= 1 for r in got)
    assert {round(r.score, 12) for r in got if r.id in (0, 1, 2)} == {round(bias, 12)}
    assert toxicity.score(no_docs, model).count() == 0
    none = toxicity.fit(edge_docs, labels.limit(0))
    assert none is None and {r.score for r in toxicity.score(edge_docs, none).collect()} == {0.0}
    assert toxicity.keep_clean(edge_docs, labels).columns == edge_docs.columns


def test_pipeline_equals_its_stages_by_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    toxic = {r.id for r in toxicity.score(documents, toxicity.fit(documents, labels)).collect()
             if r.predicted}
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()
            if r.doc_id not in toxic]
    top = {}
    for i, t in rows:
        top[t.translate(LOWER)] = max(top.get(t.translate(LOWER), i), i)
    rows = [(i, t) for i, t in rows if top[t.translate(LOWER)] == i]
    rows = [(i, t) for (i, t), (_, _, c) in zip(rows, brute_classes(rows), strict=True) if i == c]
    mark = brute_cut(rows, corpus_pipeline.PASSAGE_BYTES)
    assert sum(len(t) < len(u) for (_, t), (_, u) in zip(mark, rows, strict=True)) > 10
    want = Counter()
    for i, text in mark:
        ids = np.array(gpt_ids(text) + [2], dtype="<u4")
        starts = packing.piece_starts(len(ids), 1024)
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            want[i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    got = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    used = defaultdict(int)
    for r in got:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 1024


def test_passage_stage_cuts_planted_passages_of_51_to_64_words(spark):
    rng = random.Random(6)
    given = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect() if r.text]
    vocabulary = [w for t in given for w in WORD.findall(t.lower())]  # words as often as they stand
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    rows, passages = [], {}
    for k in range(200):
        passage = passages[k] = prose(rng.randint(51, 64))
        rows += [(2 * k, f"{prose(60)} {passage} {prose(40)}"), (2 * k + 1, f"{prose(10)}\n{passage}\n{prose(90)}")]
    rows += [(1000 + k, prose(120)) for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n_chars", F.length("text"))
    got = {r.doc_id: r for r in corpus_pipeline.passage_dedup(spark, docs, "").collect()}
    sizes = [len(p.encode()) for p in passages.values()]
    short = [k for k, p in passages.items() if len(p.encode()) < corpus_pipeline.PASSAGE_BYTES]
    assert np.median(sizes) < 450 and min(sizes) < 400 and not short
    for k, p in passages.items():
        assert p not in got[2 * k].text and p not in got[2 * k + 1].text
        assert got[2 * k].n_chars == len(got[2 * k].text) <= len(rows[2 * k][1]) - len(p)
        assert len(got[2 * k].text) > len(rows[2 * k][1]) - len(p) - 60  # the rest stays
    assert all(got[1000 + k].text == rows[400 + k][1] for k in range(100))


def test_stages_keep_the_columns_and_pass_empty_tables(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        assert out.count() == 0
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns


def test_text_shingles_follow_rows():
    hashes, rows, at = license.text_shingles(pa.array(["a b c d e f", "", "x y", None, "a b c d e"]))
    assert rows.tolist() == [0, 0, 2, 4] and at.tolist() == [0, 1, 0, 0] and hashes[0] == hashes[3]


def test_stages_keep_extra_columns_of_any_name(spark):
    folder = "/root/testdata/sf0.001"
    names = ["__id", "__n", "__text", "__own", "__kept", "__th", "__spans", "__digest", "id", "row", "own", "of_id",
             "whole_text", "spans", "dropped_id", "OWN_1"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumns({n: F.lit(n) for n in names})
    plain = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out, want = stage(spark, docs, folder), stage(spark, plain, folder)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert all(r[n] == n for r in rows for n in names)
        assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in want.collect())
    assert corpus_pipeline.pack(spark, docs, folder).count() == corpus_pipeline.pack(spark, plain, folder).count()


@pytest.mark.parametrize("least", [2, 64])
def test_hot_grams_and_hot_starts_equal_brute_force(spark, monkeypatch, least):
    """A passage in a third of the texts, in many surroundings, and many passages with one 16-byte start."""
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(900)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    hot, starts = prose(110), ["a phrase of stock " + prose(100) for _ in range(30)]
    rows = [(i, f"{prose(rng.randint(5, 40))} {hot} {prose(rng.randint(5, 40))}" if i % 3 == 0 else
             f"{prose(20)} {rng.choice(starts)} {prose(20)}") for i in range(900)]
    rows += [(2000 + i, rows[0][1]) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    plain = suffix.hot_records
    monkeypatch.setattr(suffix, "hot_records", lambda d, n, g: plain(d, n, g, share=2, least=least))
    got = suffix.removal_report(docs).collect()
    assert Counter(map(tuple, got)) == Counter(brute_removal(rows, 400))


def test_components_of_a_hub(spark):
    edges = [(0, k) for k in range(1, 4000)] + [(k, k + 10_000) for k in range(1, 4000, 7)]
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert set(got.values()) == {0} and len(got) == 4000 + len(range(1, 4000, 7))


def test_large_clusters_are_linked_to_their_centre_first(spark, monkeypatch):
    rng = random.Random(31)
    word = lambda: "w%d" % rng.randrange(10**6)
    base = [word() for _ in range(200)]
    rows = [(0, " ".join(base))]
    for i in range(1, 500):  # distinct near copies of one text, and some that are only near to a copy
        copy = list(base) if i < 440 else rows[rng.randrange(1, 440)][1].split(" ")
        for _ in range(rng.randint(1, 3)):
            copy[rng.randrange(200)] = word()
        rows.append((i, " ".join(copy)))
    units = []
    plain = minhash.verify
    monkeypatch.setattr(minhash, "verify", lambda u, *a: (units.append(u.count()), plain(u, *a))[1])
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), unit=32).collect()
    assert Counter((r.id, r.n_shingles, r.component_id) for r in got) == Counter(brute_classes(rows))
    buckets = 32 * len(rows)  # all pairs of blocks would be some (2 * 500 / 32) copies of each member in each bucket
    assert units[0] < buckets * 2 * len(rows) / 32 / 4
