import math

import pytest

SMALL = "/root/testdata/sf0.001"

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, score double, h string, idx int, `range` int"


def long_text(seed: int, n: int) -> str:
    return " ".join(f"w{(seed * 7919 + i * i * 31 + i) % 100003}" for i in range(n))


def edge_documents():
    big = long_text(1, 30_000)
    passage = long_text(3, 70)
    texts = [
        (1, None, "en", "a"), (2, "", "en", None), (3, "  \n\t ", None, "b"), (4, "one", "fr", "a"),
        (5, big, "en", "c"), (6, big, "en", "c"), (6, big, "en", "c"), (None, "a row without id", None, None),
        (None, None, None, None), (8, "é 你好 \U0001F600 ▁x  y\n\nz " * 40, "de", "b"), (9, long_text(2, 300), "en", "a"),
        (10, long_text(2, 300) + " tail", "en", "a"), (11, f"{long_text(4, 30)} {passage} {long_text(5, 30)}", "en", "b"),
        (12, f"{long_text(6, 40)} {passage} {long_text(7, 20)}", "en", "b"), (12, "another text under id twelve", "en", "b"),
        (100, "mail me: a.b@example.com, card 4111 1111 1111 1111, call +1 (202) 555-0143 or 10.0.0.255 "
              "account iban GB82 WEST 1234 5698 7654 32 ssn 078-05-1120", "en", "d"),
        (101, "Licensed under CC BY-NC 4.0. All rights reserved. GNU General Public License version 3", "en", "d"),
        (200, "x" * 50_000, "en", "e"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), "d", 0.5, "h", 1, 2) for i, t, lang, s in texts]


@pytest.fixture(scope="session")
def edge_dir(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("edge"))
    spark.createDataFrame(edge_documents(), DOCS).write.parquet(f"{out}/documents.parquet")
    labels = [(4, 0, 0), (9, 1, 0), (9, 1, 1), (10, 1, 0), (10, 0, 0), (None, 1, 0), (5, None, 0), (77, 1, 0), (11, 1, 0), (3, 0, 0)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    pages = [(1, None, None, 1), (2, "http://a.example.fr/x", "<html lang='fr'><p>le la les", 1), (2, "http://a.example.fr/x", "<html lang='fr'><p>le la les", 1),
             (None, "not a url", "", 1), (3, "https://u@b.example.de:80/", "<script>var x='<p>'</script><p>der die das " * 2000, 1)]
    spark.createDataFrame(pages, "page_id bigint, url string, html string, host int").write.parquet(f"{out}/pages.parquet")
    v = [float(i) / 7 for i in range(8)]
    vectors = [(0, v, 1), (100, v, 1), (100, v, 1), (1, v, 1), (2, [-x for x in v], 1), (3, None, 1), (4, v[:-1] + [math.nan], 1),
               (5, v[:-1] + [None], 1), (6, v[:-1] + [math.inf], 1), (7, [], 1), (8, [1.0, 2.0], 1), (None, v, 1), (300, [], 1)]
    spark.createDataFrame([(i, e, 5 if i in (2, 8) else 1, q) for i, e, q in vectors], "vec_id bigint, embedding array<float>, label int, q int").write.parquet(f"{out}/embeddings.parquet")
    return out


@pytest.fixture(scope="session")
def empty_dir(spark, edge_dir, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("empty"))
    for t in ("documents", "labels", "pages", "embeddings"):
        spark.read.parquet(f"{edge_dir}/{t}.parquet").limit(0).write.parquet(f"{out}/{t}.parquet")
    return out
