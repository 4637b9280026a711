import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: further columns, with names that the operators use themselves
EXTRA = ", h long, node string, shard int, size long, level int, kept boolean, doc string, `a b` string"


def messy_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows, and texts of several kinds."""
    rng = random.Random(4)
    words = ["the", "thing", "over", "lies", "quick", "fox", "naïve", "Über", "Straße", "42", "end.", "so", "we", "go"]
    prose = lambda n: " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))
    near = prose(120).split(" ")
    shared = "This line is long enough to be shared by many documents."
    rows = [(None, None, None, None, None), (None, "", None, None, 0), (1, None, "en", "a", None), (2, "", "en", "a", 0),
            (3, "   \n\t ", "en", None, 6), (4, "one", None, "a", 3), (5, "x" * 30_000, "en", "a", 30_000),
            (6, prose(9_000), "en", "b", 1), (7, "😀 a b   c\x1cd ▁ \r\n e", "fr", "b", 9)]
    rows += [(10 + i, " ".join(near[:i] + [f"edit{i}"] + near[i + 1 :]), "en", "a", 5) for i in range(8)]
    rows += [(20 + i, " ".join(near), "en", "a", 5) for i in range(6)]
    rows += [(30, "said twice " + prose(30), "de", "c", 1)] * 3
    rows += [(40 + i, f"{prose(12)}\n  {shared.upper() if i % 2 else shared}\t\n{prose(5)}\n{shared}", "en", "a", 5) for i in range(9)]
    rows += [(60 + i, prose(rng.randrange(10, 300)), rng.choice(["en", "de", None]), rng.choice("abc"), 5) for i in range(80)]
    rows += [(150 + i, t, "en", "a", 5) for i, t in enumerate([
        "mail me.x+1@host-a.example.org_b@c.d or ring +1 (487) 555-7209 now", "10.0.0.1 256.1.1.1 1.2.3.4.5.6.7.8 card 4111 1111 1111 1111 and 4111111111111112",
        "a@b@c.de 00000000000001.2.3.4 +1 2 +49 (0) 30-123 456 78 x@y", "1-1-1 " + "9 " * 400 + "a" * 500 + "@" * 50, "@@@ +++ ... 1.2.3"])]
    return rows


def messy_benchmark():
    """Items that are in the messy texts, short ones, ones without words, repeated ones, and nulls."""
    texts = [r[1] for r in messy_rows() if r[0] in (6, 20, 30, 61, 62)]
    cut = lambda t, a, b: "-- " + ", ".join(t.split(" ")[a:b]).upper() + "!"
    rows = [(1, cut(texts[0], 5, 40)), (2, cut(texts[1], 0, 10)), (3, cut(texts[1], 100, 120)), (4, cut(texts[2], 0, 4)), (5, "naïve  ÜBER naïve"), (6, "one"),
            (7, ""), (8, None), (9, " .,!\n"), (None, cut(texts[1], 30, 45)), (10, cut(texts[1], 30, 45)), (11, "This line is long enough to be shared by many documents."),
            (11, "This line is long enough to be shared by many documents."), (12, " ".join(f"never{i}" for i in range(300))), (12, "x" * 30_000), (13, "so so so")]
    return [r + (k, "w", "n") for k, r in enumerate(rows)]


def messy_vectors():
    """Vectors with ties, copies, repeated ids, other lengths, and rows that take no part."""
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 0.4) for _ in range(6)], rng.randrange(4)) for i in range(260)]
    rows += [(1000 + i, rows[3][1], 2) for i in range(130)]  # a third of all rows share a vector
    rows += [rows[100], rows[100], rows[7], (7, rows[8][1], 1), (7, rows[7][1], 3), (None, rows[3][1], 1), (None, rows[9][1], 2), (None, rows[9][1], 2), (200, [-x for x in rows[0][1]], 9)]
    nan, inf = float("nan"), float("inf")
    rows += [(300, None, 1), (301, [], 1), (302, [0.25, -0.5], 1), (303, [0.1, None, 0.2, 0.0, 0.0, 0.0], 1), (304, [nan] * 6, 1), (400, [inf] + [0.0] * 5, 2), (401, rows[5][1], None)]
    rows += [(500, [0.0] * 6, 3), (600, [9.0, -8.0, 7.5, 0.0, 0.0, 1.0], 7)]
    return [r + (k, "x", "v") for k, r in enumerate(rows)]


VECTORS = "vec_id long, embedding array<float>, label int, n long, x string, v string"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import local_session

    return local_session(cores="*", shuffle_partitions=8, app="tessera-llm-tests")


@pytest.fixture(scope="session")
def messy_dir(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("messy"))
    rows = [r + (i % 3, "n", 1, 2, 3, True, "d", "e") for i, r in enumerate(messy_rows())]
    rows = [r if r[0] != 30 else r[:5] + (0, "n", 1, 2, 3, True, "d", "e") for r in rows]
    spark.createDataFrame(rows, SCHEMA + EXTRA).repartition(3).write.parquet(f"{base}/documents.parquet")
    pages = [(None, None, None, 1), (1, "u", None, 1), (2, "u", "", 1), (3, "u v\r\nw", "<p>é</p>", 1), (4, None, "<p>é</p>", 1), (None, "u", "<p>é</p>", 1),
             (5, "u", "z" * 200_000, 1), (5, "u", "z" * 200_000, 1), (6, "u", "a\r\n\r\nb", 1)]
    spark.createDataFrame(pages, "page_id long, url string, html string, digest int").repartition(2).write.parquet(f"{base}/pages.parquet")
    spark.createDataFrame(messy_benchmark(), "item_id long, text string, n long, words string, slice string").repartition(3).write.parquet(f"{base}/benchmark.parquet")
    spark.createDataFrame(messy_vectors(), VECTORS).repartition(3).write.parquet(f"{base}/embeddings.parquet")
    return base


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], SCHEMA + EXTRA).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{base}/pages.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    spark.createDataFrame([], VECTORS).write.parquet(f"{base}/embeddings.parquet")
    return base
