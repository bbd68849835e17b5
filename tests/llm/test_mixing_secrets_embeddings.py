from __future__ import annotations

import hashlib
import random
import re

import duckdb
import numpy as np
from pyspark.sql import functions as F

from tidecast.llm import queries
from tidecast.llm.embeddings import compare_tile, near_vectors
from tidecast.llm.mixing import count_tokens, leaf_budgets
from tidecast.llm.secrets import Automaton, base_spans, secret_report, symbols


def small_documents(spark, n: int = 300, seed: int = 1):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        text = rng.choice([None, "", "w " * rng.randint(1, 200)]) if k % 7 == 0 else "w " * rng.randint(1, 90)
        source = "src0" if k % 3 == 0 else rng.choice([None, "x", "src1", "src7", "src12"])
        rows.append((k, text, rng.choice(["en", "de", None]), source, 1))
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"
    )


def oracle(name: str, documents) -> list:
    con = duckdb.connect()
    con.register("documents", documents.toPandas().astype({"doc_id": "int64"}))
    return con.execute(queries.ORACLES[name]).fetchall()


def test_mixing_equals_its_sql(spark, tmp_path):
    df = small_documents(spark)
    df.coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    for name in ("op8_source_mixing", "op6_exact_dedup"):
        want = con.execute(queries.ORACLES[name])
        columns = [c[0] for c in want.description]
        got = queries.QUERIES[name](spark, str(tmp_path)).select(*columns).collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall()))


def test_shortages_go_to_siblings_before_ancestors(spark):
    rows = [("a", "p", 10, 1), ("a", "q", 1000, 1), ("b", "r", 1000, 1), ("b", "s", 1000, 1)]
    tokens = spark.createDataFrame(rows, "domain string, source string, n_tokens long, doc_id long")
    got = leaf_budgets(tokens, ["domain", "source"], {"domain": {"a": 3}}, 40, 1).collect()
    given = {r.source: r.given for r in got}
    assert sum(given.values()) == 3010 * 40 // 100
    assert given["p"] == 10 and given["p"] + given["q"] == 903  # q takes what p lacks
    assert {given["r"], given["s"]} <= {150, 151}
    got = leaf_budgets(tokens, ["domain", "source"], {"domain": {"a": 9}}, 80, 1).collect()
    given = {r.source: r.given for r in got}
    assert (given["p"], given["q"]) == (10, 1000)  # all of a, the rest to b
    assert given["r"] + given["s"] == 2408 - 1010


def test_mixing_keeps_columns_and_bounds(spark):
    df = small_documents(spark).withColumn("mix_epoch", F.lit("old")).withColumn("rest", F.lit(1))
    once = queries.mix_documents(df, epochs=1)
    assert set(once.columns) == set(df.columns)
    ids = [r.doc_id for r in once.collect()]
    assert len(ids) == len(set(ids)) < 300
    twice = [(r.doc_id, r.mix_epoch) for r in queries.mix_documents(df).collect()]
    assert len(twice) == len(set(twice)) and {e for _, e in twice} <= {0, 1}
    assert queries.mix_documents(df.limit(0)).count() == 0
    words = df.select(F.sum(count_tokens())).first()[0]
    chosen = once.select(F.sum(count_tokens())).first()[0]
    assert 0.4 * words < chosen <= 0.6 * words


def plain_base(text: str) -> str:
    kinds = [
        (r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
        (r"(AKIA[A-Z0-9]+)", 20),
        (r"([0-9a-f]+)", 24),
    ]
    found = [
        (m.start(), k, f"{('assign', 'access', 'hex')[k]}:{m.start()}:{m.end()}")
        for k, (pattern, least) in enumerate(kinds)
        for m in re.finditer(pattern, text)
        if len(m[1]) >= least
    ]
    return ",".join(x[2] for x in sorted(found))


def test_secrets_base_spans(spark, documents):
    rng = random.Random(6)
    parts = ["password=", "TOKEN : '", "api_key", "=", '"', "AKIA", "ABCDEF0123456789", "0123456789abcdef", "x", " ",
             "ſecret=abcdefgh", "APIKEY=abcdefgh", "😀", "secret=ab", "zz", "-._/"]
    texts = [None, "", "a" * 200_000 + " token=abcdef"] + ["".join(rng.choices(parts, k=12)) for _ in range(400)]
    got = {r.doc_id: r for r in secret_report(documents(texts, found=1, r=2)).collect()}
    for k, t in enumerate(texts):
        want = plain_base(t or "")
        r = got[k]
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), t
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
        assert r.n_assign + r.n_access + r.n_hex == len(list(filter(None, want.split(","))))


def test_learned_formats_add_and_leave_prose_alone(spark, documents):
    rng = random.Random(9)
    key = lambda: "".join(rng.choices("0123456789abcdef", k=18))
    texts = [f"set password={key()} now" for _ in range(200)]
    texts += [f"note {key()} here"] + ["plain words and mail7.example.com/path_and_more_words 4524132264652876"]
    got = {r.doc_id: r for r in secret_report(documents(texts)).collect()}
    assert got[200].spans == "format:5:23" and got[200].n_assign == 0
    assert got[201].spans == ""
    assert secret_report(documents([])).count() == 0
    assert [r.spans for r in secret_report(documents(["abcdefgh12345678"])).collect()] == [""]


def test_automaton_prefers_its_format():
    rng = random.Random(3)
    values = ["".join(rng.choices("0123456789", k=6)) + "-" + "".join(rng.choices("XYZ", k=4)) for _ in range(300)]
    a = Automaton(values)
    assert symbols("aZ9-g") == "hUd-l"
    assert len({id(s) for s in a.next}) and a.mean_log_likelihood("123456-XYZX") >= a.least
    assert a.mean_log_likelihood("XYZX-123456") < a.least
    assert base_spans("") == []


def brute_vectors(rows, threshold):
    out = {}
    low = {k: k for k in range(len(rows))}
    links = {k: [] for k in range(len(rows))}

    def usable(v):
        return v and None not in v and np.isfinite(v).all() and np.any(v)

    for a in range(len(rows)):
        for b in range(a):
            (_, la, va), (_, lb, vb) = rows[a], rows[b]
            if la is None or la != lb or not usable(va) or not usable(vb) or len(va) != len(vb):
                continue
            x, y = np.array(va), np.array(vb)
            if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                links[a].append(b)
                links[b].append(a)
    moved = True
    while moved:
        moved = False
        for a, others in links.items():
            for b in others:
                if low[b] < low[a]:
                    low[a], moved = low[b], True
    for k, (vec_id, _, _) in enumerate(rows):
        out[vec_id] = (len(links[k]), rows[low[k]][0])
    return out


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(7)
    rows = []
    for c in range(12):
        centre = rng.normal(size=16)
        for _ in range(12):
            v = centre + rng.normal(size=16) * rng.choice([0, 0.05, 0.14, 0.3])
            rows.append((len(rows), int(c % 2), [float(x) for x in v]))
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [1.0, None], [float("inf")] * 16, [1.0, 2.0]]
    rows += [(len(rows) + k, 1, v) for k, v in enumerate(odd)]
    rows += [(len(rows) + k, None, rows[0][2]) for k in range(2)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    df = df.withColumn("uid", F.lit(1)).withColumn("cell", F.lit(2)).repartition(3)
    for block in (8, 512):
        got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(df, 0.98, block).collect()}
        assert got == brute_vectors(rows, 0.98)
    assert near_vectors(df.limit(0)).count() == 0
    same = spark.createDataFrame([(1, 0, [1.0, 1.0])] * 2 + [(None, 0, [1.0, 1.0])], df.schema.names[:0] or "vec_id long, label int, embedding array<double>")
    assert {r.n_links for r in near_vectors(same).collect()} == {2}


def test_tile_bounds_lose_nothing():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 40))
    x[100:] = x[:100] + rng.normal(size=(100, 40)) * 0.2
    axes = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    i, j = compare_tile(x, x, axes, 0.97)
    norm = np.sqrt((x * x).sum(1))
    want = np.nonzero((x @ x.T) / np.outer(norm, norm) >= 0.97)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(*map(np.ndarray.tolist, want), strict=True))
