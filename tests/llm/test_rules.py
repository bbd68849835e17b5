from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from tidecast.llm import queries
from tidecast.llm.rules import COUNTS, Rules, clean_lines, failing_rule

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = "The old mill by the river was quiet that day."


def plain_counts(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def fixture() -> list:
    rng = random.Random(4)
    words = ["a", "b", "the", "é😀", "x!!", "c***", "|", "end.", "\n", "\n", "\r\n", "\t", "\x0b", " ", " ", "»", "Licensed under", "read more", "K"]
    texts = [None, "", " \n\t\n", "a b", "a b a", "a a a a", "|\n|\n", "x " * 60, (PROSE + "\n") * 4]
    texts += ["\n".join(f"Sentence number {k} tells of {k * k} things." for k in range(30))]
    texts += ["w" * 200_000 + " " + "v " * 30_000]
    texts += [" ".join(rng.choices(words, k=rng.randint(1, 120))) for _ in range(300)]
    return [*enumerate(texts), (None, PROSE), (3, "a b"), (3, "a b")]


def test_counts_against_plain_ones(spark, documents):
    rows = fixture()
    got = clean_lines(documents(rows)).collect()
    want = [(k, *plain_counts(t)) for k, t in rows]
    assert sorted(map(repr, ((r.doc_id, *(r[c] for c in COUNTS[:5])) for r in got))) == sorted(
        map(repr, want)
    )
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and 100 * r.lost_chars <= 30 * r.word_chars)


def test_equals_its_sql(spark, documents, tmp_path):
    documents([(k, t) for k, t in fixture() if k is not None]).coalesce(2).write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(queries.ORACLES["op13_quality_rules"])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES["op13_quality_rules"](spark, str(tmp_path)).select(*columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall()))


def test_each_rule(spark):
    cases = {
        PROSE: None,
        "": None,
        "  \t": None,
        "A heading without an end": "no_end",
        "He said \"Stop!\"  ": None,
        "It began well. Then it was cut off in the mid": None,
        "Wow!! So!! Loud!! Here!!": "doubled",
        "One loud word!! in a line that goes on and on for a while.": None,
        "Home | Products | News | Help.": "navigation",
        "Either this | or that may be written in a longer line of prose now and then.": None,
        "Read more...": "navigation",
        "They did read more than anybody in the whole town had read before them.": None,
        "Copyright 2020 by nobody.": "boilerplate",
        "RELEASED UNDER THE MIT License.": "boilerplate",
    }
    df = spark.createDataFrame([(k,) for k in cases], "line string")
    got = {r.line: r.rule for r in df.select("line", failing_rule(F.col("line")).alias("rule")).collect()}
    assert got == cases


def test_documents_that_lose_too_much_go(spark, documents):
    rng = random.Random(2)
    sentence = lambda: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(12)) + "."
    good = [sentence() for _ in range(10)]
    noisy = good[:5] + [" | ".join(s.split()) for s in good[5:]]
    texts = ["\n".join(good), "\n".join([*good, "Released under the MIT License."]), "\n".join(noisy)]
    got = {r.doc_id: r for r in clean_lines(documents(texts)).collect()}
    assert [got[k].kept for k in range(3)] == [True, True, False]
    assert got[1].clean_text == texts[0] and got[2].n_failed_lines == 5
    lenient = clean_lines(documents(texts), Rules(max_lost=60)).collect()
    assert all(r.kept for r in lenient)


def test_native_clashing_names_and_empty_table(spark, documents):
    df = documents([PROSE], raw="r", words="w", lines=1, windows=2, places="p", failed=True, kept="old", n_words="x")
    out = clean_lines(df)
    assert out.columns.count("kept") == 1
    row = out.collect()[0]
    assert (row.raw, row.words, row.failed, row.n_words) == ("r", "w", True, 10)
    assert clean_lines(documents([])).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
