"""Line dedup against brute force, hot keys, bitmaps and clashing names."""

import hashlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from quarry.llm import lines, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANKS = " \t\n\x0b\x0c\r"


def brute(rows, least_chars=20, least_docs=3):
    """(id, n_lines, n_dropped, remaining text) of every row."""
    low = lambda i: (i is not None, i or 0)  # noqa: E731  null is the smallest
    holders = defaultdict(set)
    key = lambda x: x.strip(BLANKS).translate(LOWER)
    for i, t in rows:
        for x in (t or "").split("\n"):
            holders[key(x)].add(i)
    gone = lambda i, x: (len(key(x)) >= least_chars and len(holders[key(x)]) >= least_docs
                         and i != max(holders[key(x)], key=low))
    out = []
    for i, t in rows:
        parts = (t or "").split("\n")
        left = [x for x in parts if not gone(i, x)]
        out.append((i, len(parts), len(parts) - len(left), "\n".join(left)))
    return out


def got(docs, **options):
    return Counter((r.id, r.n_lines, r.n_dropped, r.clean_text)
                   for r in lines.line_report(docs, **options).collect())


SHARED = "Subscribe to our weekly letter today"
EDGES = [
    (1, SHARED + "\nfirst"), (2, "  " + SHARED.upper() + "\t\nsecond\n\n"), (3, SHARED + "\r\n" + SHARED),
    (4, "exactly twenty chars"), (5, "exactly twenty chars\nx"), (6, "y\nEXACTLY TWENTY CHARS"),
    (7, "nineteen characters"), (8, "nineteen characters"), (9, "nineteen characters"),
    (10, "only two documents hold this"), (11, "only two documents hold this"), (None, SHARED), (None, None),
    (12, None), (13, ""), (14, "\n\n"), (3, SHARED + "\r\n" + SHARED), (3, "other text of three\n" + SHARED),
    (15, "É" * 19 + "é"), (16, "É" * 19 + "é"), (17, "É" * 19 + "é"), (18, "é" * 20),
    (19, "\n".join(f"line number {k} of a long text, {SHARED if k % 70 == 5 else ''}" for k in range(3000))),
    (20, "\n".join([SHARED] * 200 + ["end"])), (21, "x" * 400_000 + "\n" + SHARED)]


def test_line_report_equals_brute_force(spark, edge_docs, edge_rows, medium_docs, medium_rows):
    docs = spark.createDataFrame(EDGES, "doc_id bigint, text string").repartition(3)
    assert got(docs) == Counter(brute(EDGES))
    assert got(docs, least_chars=1, least_docs=2) == Counter(brute(EDGES, 1, 2))
    assert got(edge_docs, least_docs=2) == Counter(brute(edge_rows, least_docs=2))
    assert got(medium_docs) == Counter(brute(medium_rows))


def test_hot_keys_are_decided_without_gathering_them(spark):
    rows = [(i, f"{SHARED}\nnothing else stands here twice: {i}" + (f"\n{SHARED} again" if i % 2 else ""))
            for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = lines.hot_keys(lines.records(docs, "doc_id", "text", 20), 8).collect()
    assert len(found) == 2
    assert got(docs) == Counter(brute(rows))


def test_bitmaps_leave_out_whole_words_and_unroll(spark):
    gone = [0, 63, 64, 200, 201]
    drops = spark.createDataFrame([(1, 2, p) for p in gone + gone], "r1 bigint, r2 bigint, pos int")
    row = lines.bitmaps(drops).withColumn("dense", lines.dense(F.col("keep"))).first()
    assert [x.word for x in row.keep] == [0, 1, 3] and len(row.dense) == 4 and row.dense[2] == -1
    assert [k for k in range(256) if not row.dense[k // 64] >> (k % 64) & 1] == gone


def test_drop_lines_keeps_columns_of_any_name(spark):
    names = ["r1", "r2", "pos", "keep", "id", "h1", "bitmap", "key1", "key2", "KEEP_1", "words"]
    docs = spark.createDataFrame(EDGES, "doc_id bigint, text string") \
        .withColumns({n: F.lit(n) for n in names})
    out = lines.drop_lines(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert Counter((r.doc_id, r.text or "") for r in rows) == Counter((x[0], x[3]) for x in brute(EDGES))
    assert sum(r.text is None for r in rows) == 2 and all(r[n] == n for r in rows for n in names)


def test_empty_table(no_docs):
    assert lines.line_report(no_docs).count() == 0
    assert lines.drop_lines(no_docs).columns == no_docs.columns


def test_query_has_no_python_and_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    out = queries.op13_line_dedup(spark, folder)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    want = Counter((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(rows))
    assert Counter(tuple(r) for r in out.select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()) == want
