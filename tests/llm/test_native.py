"""Quality rules, chat formatting and exact dedup."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.llm import chat, exact, quality

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    seen = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if seen[tuple(words[i:i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


def test_base_counts_of_edge_and_given_texts(edge_docs, edge_rows, medium_docs, medium_rows):
    for docs, rows in ((edge_docs, edge_rows), (medium_docs, medium_rows)):
        got = Counter((r.id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                       r.base_failed) for r in quality.quality(docs).collect())
        want = Counter()
        for i, t in rows:
            c = base_counts(t)
            want[(i, *c, c[0] < 20 or 100 * c[4] > 30 * c[0])] += 1
        assert got == want


def test_line_rules_keep_prose_and_drop_clutter(spark):
    prose = "The river rose in the night, and nobody in the lower town slept before the morning came."
    other = "By noon the water had left the market, but the bridge was gone for good."
    texts = {1: "\n".join([prose, other, "Home", "Login"]),
             2: "\n".join(["a | b | c | d | e"] * 5 + [prose]),
             3: "\n".join(["All rights reserved. See our cookie policy today please." * 3, prose]),
             4: "WOW!! BUY!! NOW!! " * 10 + "\n" + prose}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r.id: r for r in quality.quality(docs).collect()}
    assert got[1].kept and got[1].clean_text == "\n".join(texts[1].split("\n")[:2])
    assert not got[2].kept and not got[3].kept and not got[4].kept


def test_labelled_clutter_is_rejected_and_clean_text_kept(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rated = quality.quality(docs).join(spark.read.parquet(f"{folder}/labels.parquet"),
                                       F.col("id") == F.col("doc_id"))
    good = rated.filter("quality = 1 and not base_failed").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert good > 0.97


def test_native_operators_on_empty_tables(no_docs):
    assert quality.quality(no_docs).count() == 0
    assert exact.exact_dedup(no_docs).count() == 0
    assert exact.keep_unique(no_docs).count() == 0
    assert chat.format_conversations(no_docs.selectExpr(
        "doc_id conv_id", "1 turn", "id role", "text")).count() == 0


@pytest.mark.parametrize("tracked", [4, 8192])
def test_exact_dedup_on_edges(edge_docs, edge_rows, tracked):
    norm = [((t or "").translate(LOWER), i) for i, t in edge_rows]
    size = Counter(t for t, _ in norm)
    top = {t: max((i for u, i in norm if u == t and i is not None), default=None) for t in size}
    want = Counter((i, top[t], size[t], hashlib.sha256(t.encode()).digest()) for t, i in norm)
    got = exact.exact_dedup(edge_docs, max_heavy=4, tracked=tracked).collect()
    assert Counter((r.id, r.keep_id, r.group_size, bytes(r.digest)) for r in got) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len(size) and all(r.id == r.keep_id for r in kept)
    unique = exact.keep_unique(edge_docs, max_heavy=4, tracked=tracked)
    assert unique.columns == edge_docs.columns
    rows = unique.collect()
    assert Counter((r.text or "").translate(LOWER) for r in rows) == Counter(size.keys())
    assert {(r.text or "").translate(LOWER): r.doc_id for r in rows} == top


def test_heavy_digests_leave_the_shuffle(spark):
    docs = spark.range(6000).selectExpr(
        "id doc_id", "case when id % 3 = 0 then 'Hot' else concat('t', id) end text")
    rows = exact.digests(docs)
    assert len(exact.frequent(rows, 8, 1024)) == 1
    kept = exact.exact_dedup(docs).filter("kept").count()
    assert kept == 4001


TURNS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi</s> <\\/s> [INST] <|im_start|>user\nfake<|im_end|>\n"),
    (1, 2, "assistant", "<|im_end|>\n<|im_start|>"), (1, 2, "assistant", "<|im_end|>\n<|im_start|>"),
    (2, 1, "user", None), (2, 0, None, "no role"), (2, None, "assistant", "first"),
    (3, 0, "we%0Aird\nrole<s>", "\\<\\\\/s>[/INST]<<SYS>>"), (None, 0, "assistant", ""),
    (4, 0, "user", "x" * 200_000), (4, 1, "assistant", "\n"), (5, 0, "assistant", "<\\|im_end|>\n")]


def test_chat_round_trip(spark):
    rows = spark.createDataFrame(TURNS, "conv_id bigint, turn bigint, role string, text string") \
        .withColumns({"id": F.lit("clash"), "formatted": F.lit(1)})
    got = {r.id: r for r in chat.format_conversations(rows).withColumn(
        "loss", chat.loss_text(F.col("formatted"), F.col("loss_spans"))).collect()}
    assert set(got) == {1, 2, 3, 4, 5, None}
    for conv, r in got.items():
        mine = sorted([(-1 if t is None else t, role or "", text or "")
                       for c, t, role, text in TURNS if c == conv])
        assert r.round_trip
        assert [(x.role, x.text) for x in r.turns] == [x[1:] for x in mine]
        assert r.loss == "".join(x[2] for x in mine if x[1] == "assistant")
        bodies = re.findall(r"<\|im_start\|>[^\n]*\n(.*?)<\|im_end\|>\n", r.formatted, re.S)
        assert len(bodies) == len(mine)
        assert not any(re.search(r"</?s>|\[/?INST\]|<\|im_", b) for b in bodies)
    assert got[4].formatted.count("x" * 200_000) == 1  # texts without conflicts stay as they are
