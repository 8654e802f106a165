import random

import pytest

CLASHING = "id string, row int, digest string, kept string, key int, h int, slot int, sequence_id string"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty, blank, very long and repeated texts, ties, repeated rows, clashing columns."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghié") for _ in range(rng.randint(2, 8))) for _ in range(900)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n)) + "."
    passage = prose(90)
    texts = [None, "", " \t\n ", "One two", "one TWO", prose(40), prose(60) + "\n" + passage,
             passage + " " + prose(30), prose(20_000), "ab " * 400, "漢字 🙂 " * 30, "\x85é　x  y\n\n z"]
    texts += [texts[5].upper(), texts[5], texts[6] + " tail", "Released under the MIT License.\n" + prose(30)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(5, texts[5]), (5, texts[5]), (None, texts[7]), (None, None)]
    return spark.createDataFrame(
        [(*r, "x", 1, "d", "k", 2, 3, 4, "s") for r in rows],
        f"doc_id bigint, text string, {CLASHING}").repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def edge_rows(edge_docs):
    return [(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def medium_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    return [(r.doc_id, r.text) for r in df.collect()]


@pytest.fixture(scope="session")
def medium_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
