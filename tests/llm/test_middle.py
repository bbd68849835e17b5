from __future__ import annotations

import hashlib
import random
import re

import duckdb
from pyspark.sql import functions as F

from tidecast.llm import queries
from tidecast.llm.middle import Middle, Reader, middle_digests, middle_pieces, middle_texts, restored


def plain(doc_id: int | None, text: str | None, seed: int = 7, rate: int = 100, spm: int = 50):
    """Form, counts and output by the definition."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def fixture() -> list:
    rng = random.Random(5)
    marks = ["<P>", "<S>", "<M>", "<", "P>", "<S", "\n", "\n\n", "a b", "é😀", "ß\n", "\r\n", " "]
    texts = [None, "", "\n", "\n\n\n", "<P>", "a<M>b\n", "one line", "<", "x" * 5000, "x\n" * 5000]
    texts += ["ü" * 40_000 + "\n" + "line of words\n" * 3000]
    texts += ["".join(rng.choices(marks[3:] * 3 + marks[:1], k=rng.randint(1, 60))) for _ in range(200)]
    return [*enumerate(texts), (None, "a\nb\nc"), (7, "twin\n" * 9), (7, "twin\n" * 9)]


def digest(text: str | None) -> str:
    return hashlib.sha256((text or "").encode()).hexdigest()


def test_against_the_definition(spark, documents):
    rows = fixture()
    for how in (Middle(), Middle(chunk=1), Middle(chunk=50, rate=60, spm=20, seed=3)):
        df = documents(rows, row="r", place=1, data="d", form="f", n=3)
        got = middle_digests(middle_pieces(df, how), how).collect()
        want = []
        for k, text in rows:
            *counts, output = plain(k, text, how.seed, how.rate, how.spm)
            want.append((k, *counts, digest(output), digest(text)))
        found = [
            (r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256)
            for r in got
        ]
        assert sorted(map(repr, found)) == sorted(map(repr, want))


def test_whole_outputs_and_back(spark, documents):
    rows = fixture()
    got = middle_texts(middle_pieces(documents(rows), Middle(chunk=64))).collect()
    assert sorted((repr(r.doc_id), r.output) for r in got) == sorted(
        (repr(k), plain(k, t)[-1]) for k, t in rows
    )
    by_id = {r.doc_id: r for r in got}
    for k, text in rows[:200]:
        if k != 7:
            assert restored(by_id[k].output, by_id[k].form) == (text or "")


def test_reader_finds_sentinels_across_pieces():
    marks = Middle().marks()
    for size in (1, 2, 3, 4, 50):
        reader = Reader("spm", marks)
        output = b"<S>su<S<<P>pre\n<<M>mid<"
        found = []
        for k in range(0, len(output), size):
            found += reader.feed(output[k : k + size])
        found += reader.end()
        parts = {p: b"".join(d for q, d in found if q == p) for p in "PSM"}
        assert parts == {"S": b"su<S<", "P": b"pre\n<", "M": b"mid<"}


def test_equals_its_sql(spark, documents, tmp_path):
    rows = [(k, t) for k, t in fixture() if k is not None]
    documents(rows).coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(queries.ORACLES["op11_fill_in_middle"])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES["op11_fill_in_middle"](spark, str(tmp_path)).select(*columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall()))


def test_one_shuffle_and_empty_table(spark, documents):
    assert middle_digests(middle_pieces(documents([]))).count() == 0
    plan = middle_digests(middle_pieces(documents(["a\nb"])))._jdf.queryExecution().executedPlan()
    assert plan.toString().count("Exchange hashpartitioning") == 1
    copies = documents([(1, "same\ntext\n")] * 50).withColumn("doc_id", F.lit(1).cast("long"))
    assert len({r.output_sha256 for r in middle_digests(middle_pieces(copies)).collect()}) == 1
