"""Whitening, secrets and hard negatives against plain Python and DuckDB."""

import hashlib
import re
import time

import duckdb
import numpy as np
import pytest

from tessera.llm import negatives, secrets, whitening
from tessera.llm.registry import QUERIES

from .conftest import SMALL

SF = "/root/testdata/sf0.01"


# --- whitening ------------------------------------------------------------------

def check_whitening(rows, ids, vectors):
    """Rows of op11 against numpy on the valid vectors."""
    x = np.floor(64.0 * vectors).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    centred = (n * x - s).astype(object)
    v = np.cov(x.T.astype(np.float64), bias=True)
    values = np.sort(np.linalg.eigvalsh(v))[::-1]
    k = min(32, int((values > 1e-9 * values[0]).sum()))
    assert len(rows) == n * k and {r["n"] for r in rows} == {n}
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] <= 1e-4
    got = {}
    for r in rows:
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    w = np.array([[got[i][c]["whitened"] for c in range(1, k + 1)] for i in ids])
    assert [got[i][1]["deviation"] for i in ids] == [int(d) for d in (centred ** 2).sum(axis=1)]
    for c in range(1, k + 1):
        assert got[ids[0]][c]["explained"] == pytest.approx(values[c - 1] / np.trace(v), rel=1e-9)
    # whitened = centred rows on unit eigenvectors: solve for the axes and test them
    axes = np.linalg.lstsq((x - s / n), w * np.sqrt(values[:k]), rcond=None)[0]
    assert np.abs(axes.T @ axes - np.eye(k)).max() < 1e-8
    assert np.abs(v @ axes - axes * values[:k]).max() < 1e-7 * values[0]
    assert np.abs(np.cov(w.T, bias=True) - np.eye(k)).max() < 1e-8


def test_whitening_of_a_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    check_whitening(QUERIES["op11_whitening"](spark, SF).collect(), [r["vec_id"] for r in rows],
                    np.array([r["embedding"] for r in rows], np.float64))


def test_whitening_edges(spark, edge_dir):
    rows = QUERIES["op11_whitening"](spark, edge_dir).collect()
    # valid: 0, 100 twice, 1, 2, [], [1, 2], the row without id, another []
    assert {r["vec_id"] for r in rows} == {0, 100, 1, 2, 7, 8, None, 300}
    k = max(r["component"] for r in rows)
    assert rows[0]["n"] == 9 and len(rows) == 9 * k and k == 3  # one vector, its negative (floors differ), and one other
    assert rows[0]["identity_error"] < 1e-4
    deviation = {}
    for r in rows:
        deviation.setdefault(r["vec_id"], set()).add(r["deviation"])
    v = [np.floor(64 * np.float32(i / 7)) for i in range(8)]
    table = np.array([v, v, v, v, [np.floor(-64.0 * np.float32(i / 7)) for i in range(8)], [0] * 8, [64, 128] + [0] * 6, v, [0] * 8])
    want = ((9 * table - table.sum(axis=0)) ** 2).sum(axis=1)
    assert deviation[0] == {int(want[0])} and deviation[2] == {int(want[4])} and deviation[8] == {int(want[6])}


def test_whitening_of_equal_and_of_huge_vectors(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id bigint, embedding array<double>")
    rows, model, error = whitening.whitened_rows(same)
    assert rows.count() == 0 and len(model.values) == 0 and error == 0.0
    # far apart: sums of squares leave 64 bits, decimals hold them
    far = spark.createDataFrame([(i, [float((-1) ** i * 2 ** 29 + i), float(i)]) for i in range(20)], "vec_id bigint, embedding array<double>")
    rows, model, _ = whitening.whitened_rows(far)
    x = [[64 * ((-1) ** i * 2 ** 29 + i) + 10 ** 6, 64 * i + 10 ** 6] for i in range(20)]
    s = [sum(r[0] for r in x), sum(r[1] for r in x)]
    assert {r["vec_id"]: int(r["deviation"]) for r in rows.collect()} == {
        i: sum((20 * a - b) ** 2 for a, b in zip(x[i], s)) for i in range(20)}
    with pytest.raises(Exception, match="no integer form"):
        whitening.whitened_rows(spark.createDataFrame([(1, [2.0 ** 31])], "vec_id bigint, embedding array<double>"))


@pytest.mark.parametrize("kind", ["random", "repeated", "diagonal", "low rank", "one"])
def test_leading_components(kind):
    rng = np.random.default_rng(7)
    n = 1 if kind == "one" else 48
    q = np.linalg.qr(rng.standard_normal((n, n)))[0]
    values = {"random": rng.random(n), "repeated": np.repeat([5.0, 2.0, 1e-3], 16), "diagonal": np.arange(n, dtype=float),
              "low rank": np.r_[np.ones(5) * 3, np.zeros(43)], "one": np.array([2.5])}[kind]
    m = np.diag(values) if kind in ("diagonal", "one") else (q * values) @ q.T
    m = (m + m.T) / 2
    got, axes = whitening.leading_components(m, 20)
    want = np.sort(values)[::-1][:len(got)]
    assert len(got) == {"low rank": 5, "one": 1}.get(kind, 20)
    assert np.abs(got - want).max() < 1e-12 * values.max()
    assert np.abs(axes.T @ axes - np.eye(len(got))).max() < 1e-11
    assert np.abs(m @ axes - axes * got).max() < 1e-12 * values.max()


# --- secrets --------------------------------------------------------------------

def base_of(t):
    out = []
    for m in re.finditer(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for m in re.finditer(r"AKIA[A-Z0-9]+", t):
        if len(m[0]) >= 18:
            out.append((m.start(), 1, f"access:{m.start()}:{m.end()}"))
    for m in re.finditer(r"[0-9a-f]+", t):
        if len(m[0]) >= 16:
            out.append((m.start(), 2, f"hex:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


@pytest.mark.parametrize("sf", [SMALL, SF])
def test_secrets_of_a_table(spark, sf):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op12_secrets"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base_of(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s.startswith(k) for s in want) for k in ("assign", "access", "hex")]
        spans = r["spans"].split(",") if r["spans"] else []
        assert [s for s in spans if not s.startswith("literal")] == want and len(spans) == len(want) + r["n_literal"]


def test_base_spans_of_hard_texts():
    rng = np.random.default_rng(3)
    pieces = ["password", "PASSWD", "secret", "Token", "api_key", "APIKEY", "apiKEY", "ſecret", "toKen", "=", ":", " ", "  ", '"', "'", "abcdefgh1234", "AKIA",
              "ABCDEFGHIJKLMNOP", "0123456789abcdef", "deadbeef", "é", "\U0001F600", "\n", "x", "-", "/", "Z9"]
    for _ in range(3000):
        t = "".join(rng.choice(pieces, rng.integers(1, 30)))
        assert [f"{s['kind']}:{s['start']}:{s['end']}" for s in secrets.spans_of(t) if s["base"]] == base_of(t), t


SECRET = "9fK3-xQ7z!Lm2"


@pytest.mark.parametrize("text", [
    f'password = "{SECRET}"', f"db_password: '{SECRET}'", f'"apiKey": "{SECRET}"', f'const String AUTH_TOKEN = "{SECRET}";',
    f'password: str = "{SECRET}"', f'config["client_secret"] = "{SECRET}"', f'client.passphrase := "{SECRET}"', f"export DB_PASSWORD={SECRET}",
    f'k = "{SECRET}"\nunrelated = 1\nclient.api_key = k', f'a = "{SECRET}"\nb = a\nc = b\nsecret = c', f"<password>{SECRET}</password>",
    f'<add key="password" value="{SECRET}"/>', f'setPassword("{SECRET}")', f'props.put("db.password", "{SECRET}")',
    f'connect(host="h", password="{SECRET}")', f'token = os.getenv("TOKEN", "{SECRET}")', f'if (password == "{SECRET}")',
    f"secret => '{SECRET}'", f'token = b"{SECRET}"', f'token = bytes("{SECRET}")', f'x = "{SECRET}"\ntoken = f"Bearer {{x}}"',
    f'token = env or "{SECRET}"', f'private_key = """\n' + f'"""\npassword = "{SECRET}"', f"it isn't so\npasswd: {SECRET}",
])
def test_literals_by_target_name(text):
    start = text.index(SECRET)
    found = [(s["start"], s["end"]) for s in secrets.spans_of(text) if s["kind"] == "literal"]
    assert (start, start + len(SECRET)) in found


def test_joined_literals_count_together():
    text = 'a = "x9F2"\nb = "Qz81k"\napi_key = a + "-" + b + "77pL"'
    spans = [text[s["start"]:s["end"]] for s in secrets.spans_of(text) if s["kind"] == "literal"]
    assert spans == [] or set(spans) <= {"x9F2", "Qz81k", "77pL"}
    text = 'part = "x9F2Lw07"\npassword = part + "Qz81kTr5"'
    assert [text[s["start"]:s["end"]] for s in secrets.spans_of(text) if s["kind"] == "literal"] == ["x9F2Lw07", "Qz81kTr5"]


@pytest.mark.parametrize("text", [
    "", "plain words without anything", 'title = "9fK3-xQ7z!Lm2"', 'password = "changeme"', 'password = "<your password>"', "password: is what you type",
    'password = getpass()', 'token = os.environ["TOKEN_NAME_X1"]', 'max_tokens = "9fK3-xQ7z!Lm2"', 'password_hint = "9fK3-xQ7z!Lm2"', 'public_key = "9fK3-xQ7z!Lm2"',
    'k = "9fK3-xQ7z!Lm2"\nk = "other"\napi_key = k', "The secret of the token is auth.", 'secret = "${VAULT_VALUE_1}"', 'keyboard = "9fK3-xQ7z!Lm2"',
])
def test_what_is_no_secret(text):
    assert [s for s in secrets.spans_of(text) if s["kind"] == "literal"] == []


def test_lexing_takes_linear_time():
    def seconds(n):
        texts = ['password="\\' * n, "'" * n + '"' * n + "password", "password=" * n, 'a=b\n' * n + 'password="x9F2Lw07Qz81k"', "a=a+a\n" * n + "token=a",
                 'token = "x"+' * n, "<" * n + "password", "password(" * n, '"token",' * n, "token=x or " * n, "token = str(" * n, "secret " * n, "token " + " " * n]
        t0 = time.process_time()
        for t in texts:
            secrets.spans_of(t)
        return time.process_time() - t0

    seconds(100)
    assert seconds(40_000) < 12 * max(seconds(10_000), 0.05)


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(1, 'password = "9fK3-xQ7z!Lm2"', "a", 7), (1, None, "b", 8)], "doc_id bigint, text string, secrets string, `kind.x` int")
    rows = secrets.with_secrets(df, "text", "secrets").collect()
    assert [r["kind.x"] for r in rows] == [7, 8] and [len(r["secrets"]) for r in rows] == [1, 0]
    assert rows[0]["secrets"][0]["name"] == "password"


def test_secrets_edges(spark, edge_dir):
    rows = QUERIES["op12_secrets"](spark, edge_dir).collect()
    from .conftest import edge_documents
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(d[0]) for d in edge_documents())
    empty = [r for r in rows if r["doc_id"] in (1, 2, 3)]
    assert all(r["spans"] == "" and r["n_hex"] == 0 and r["base_sha256"] == hashlib.sha256(b"").hexdigest() for r in empty)


# --- hard negatives --------------------------------------------------------------

def brute_negatives(table):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{table}')")
    cols = "anchor_id, positive_id, rank, negative_id, positive_score, negative_score"
    return sorted(con.execute(f"select {cols} from ({negatives.OP13_SQL})").fetchall(), key=str)


def ours(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("sf", [SMALL, SF])
def test_negatives_of_a_table(spark, sf):
    assert ours(QUERIES["op13_negatives"](spark, sf)) == brute_negatives(f"{sf}/embeddings.parquet")


def test_negatives_with_ties_repeats_and_missing_values(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(600):
        v = [float(x) for x in rng.integers(-3, 4, 6) / 4]
        rows.append((int(rng.choice([100 * rng.integers(0, 4), i])), v, int(rng.integers(0, 3))))
    rows += rows[:60] + [rows[0]] * 30  # repeated rows, anchors among them
    rows += [(None, rows[3][1], 1), (None, rows[4][1], 0), (100, None, 1), (200, [None] * 6, 1), (300, [0.0] * 6, None), (5, [float("nan")] + [0.0] * 5, 0)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    want = brute_negatives(f"{tmp_path}/embeddings.parquet/*.parquet")
    monkeypatch.setattr(negatives, "CHUNK_POINTS", 100)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 20)
    assert len(want) > 1000 and ours(QUERIES["op13_negatives"](spark, str(tmp_path))) == want


def test_negatives_edges(spark, edge_dir):
    got = ours(QUERIES["op13_negatives"](spark, edge_dir))
    assert got and all(r[0] in (0, 100, 300) and not {3, 4, 5, 6} & {r[1], r[3]} for r in got)
    assert [r for r in got if r[:2] == (300, None)]  # a row without id takes part


@pytest.mark.parametrize("top", [1, 40, 3000, 10 ** 6, 2 ** 27])
def test_packed_products_are_exact(top):
    rng = np.random.default_rng(top)
    points = rng.integers(-top, top + 1, (37, 16))
    bound = max(0, -int(points.min()))
    most = max(sum((int(v) + bound) ** 2 for v in p) for p in points)
    packed = negatives.Packed(points, bound, most)
    assert packed.fields >= 2 and (packed.dtype == object) == (top >= 10 ** 6)
    want = points.astype(object) @ points.T.astype(object)
    assert (packed.scores(points[:9]) == want[:9]).all()


def test_huge_components_fail(spark):
    rows = [(i, [float(2 ** 30 + i)] * 4, i % 2) for i in range(101)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    from pyspark.sql import functions as F
    with pytest.raises(Exception, match="do not fit"):
        negatives.mine(negatives.points_of(df, F.col("label")), F.col("vec_id") % 100 == 0).collect()
