from __future__ import annotations

import random
import zlib
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.llm.quality import STATISTICS, keep_good, quality_scores, statistics
from tidecast.llm.toxicity import ToxicModel, features_of, fit_toxicity, toxicity_scores, words


def corpus(n: int, seed: int = 3):
    """(id, text, quality, toxic): junk repeats words or shouts, toxic texts hold one bad word."""
    rng = random.Random(seed)
    out = []
    for k in range(n):
        body = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(60)]
        good, toxic = k % 5 != 0, k % 4 == 0
        if toxic:
            body[rng.randrange(60)] = rng.choice(["vileword", "nastyword"])
        text = " ".join(body) + "."
        if not good:
            text = (body[0] + " ") * 60 if k % 2 else text.upper().replace(" ", "!! ")
        out.append((k, text, int(good), int(toxic)))
    return out


def tables(spark, documents, rows, extra=()):
    docs = documents([(k, t) for k, t, _, _ in rows] + list(extra), score=1.0, x="x", label=9)
    labels = spark.createDataFrame(
        [(k, q, t) for k, _, q, t in rows] + [(None, 1, 1), (0, None, None)],
        "doc_id long, quality int, toxic int",
    )
    return docs, labels


def test_quality_learns_and_keeps_defined_cases(spark, documents):
    rows = corpus(300)
    docs, labels = tables(spark, documents, rows, [(None, "a b c"), (900, None), (901, ""), (901, "")])
    got = quality_scores(docs, labels).collect()
    assert len(got) == 304
    truth = {k: q for k, _, q, _ in rows}
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {
        k for k in [*truth, 900, 901] if zlib.crc32(str(k).encode()) % 5 == 0
    }
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    right = [r.predicted == truth[r.doc_id] for r in held if r.doc_id in truth]
    assert np.mean(right) > 0.95
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns
    scores = {r.doc_id: r.predicted for r in got}
    assert {r.doc_id for r in kept.collect()} == {k for k, p in scores.items() if p}


def test_quality_without_labels_or_rows(spark, documents):
    docs = documents(["some words here", None])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality_scores(docs, none).collect()} == {0.5}
    assert quality_scores(documents([]), none).count() == 0
    one = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality_scores(docs, one).collect()} <= {0.5, 1.0}


def test_statistics_of_odd_texts():
    for text in (None, "", "   ", "\n", "x", "é" * 10, "word " * 50_000):
        x = statistics(text)
        assert len(x) == len(STATISTICS) and np.isfinite(x).all()


def test_toxicity_finds_words_whatever_the_length(spark, documents):
    rows = corpus(400)
    filler = " ".join(t for _, t, q, x in rows if q and not x)
    extra = [(None, "vileword"), (900, None), (901, ""), (902, filler + " nastyword " + filler)]
    docs, labels = tables(spark, documents, rows, extra)
    got = toxicity_scores(docs, labels).collect()
    assert len(got) == 404
    truth = {k: t for k, _, q, t in rows if q}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert held and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert {r.predicted for r in got if r.doc_id == 902} == {1}
    assert {r.predicted for r in got if r.doc_id in (900, 901)} == {0}
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_toxicity_of_copies_counts_once(spark, documents):
    """A passage copied into many toxic texts does not make its words toxic."""
    rows = corpus(400)
    copied = "calmly spoken ordinary sentence " * 3
    docs = [(k, t) for k, t, _, _ in rows] + [(1000 + k, copied + " vileword") for k in range(80)]
    labels = [(k, x) for k, _, _, x in rows] + [(1000 + k, 1) for k in range(80)]
    df = documents(docs + [(5000, copied)])
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity_scores(df, known).collect()}
    assert got[5000] == 0


def test_toxicity_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity_scores(documents(["a b"]), none).collect()] == [0.0]
    assert toxicity_scores(documents([]), none).count() == 0


def test_toxic_features():
    model = ToxicModel({"bad": 4.0, "good": -1.0}, 0.5, span=1)
    assert model.features("Bad, good other") == pytest.approx(((4 - 1 + 0.5) / 3, 4.0))
    assert ToxicModel({"bad": 4.0}, 0.0, span=2).features("bad bad x") == pytest.approx((8 / 3, 4.0))
    assert model.features(None) == (0.0, 0.0) and words("  ") == []


def test_toxicity_counts_all_rows_and_keeps_the_prior(spark, documents):
    """The bound on the curve's sample changes neither the model's counts nor the class shares."""
    rng = random.Random(5)
    rows = []
    for k in range(1200):
        toxic = rng.random() < 0.1
        body = rng.choices("abcdefghijklmnop", k=30)
        if rng.random() < (0.7 if toxic else 0.1):
            body[rng.randrange(30)] = "vileword"
        rows.append((k, " ".join(body), int(toxic)))
    df = documents([(k, t) for k, t, _ in rows])
    known = spark.createDataFrame([(k, x) for k, _, x in rows], "doc_id long, toxic int")
    whole = fit_toxicity(df, known, "toxic", F.lit(True))
    cut = fit_toxicity(df, known, "toxic", F.lit(True), per_class=15)
    assert cut.ratios == whole.ratios and cut.rare == whole.rare
    for model in (whole, cut):
        x = np.array([model.features(t) for _, t, _ in rows])
        assert abs(model.score(x).mean() - np.mean([x for _, _, x in rows])) < 0.06


def test_toxicity_keeps_every_word_beyond_the_table_bound(spark, documents):
    """More kept words than ``entries``: each still scores by its own ratio, through a join."""
    rows = corpus(400)
    docs, labels = tables(spark, documents, rows, [(900, None), (901, ""), (902, "vileword")])
    whole = {r.doc_id: r.score for r in toxicity_scores(docs, labels).collect()}
    bounded = toxicity_scores(docs, labels, entries=2).collect()
    assert len(bounded) == len(whole) == 403
    assert {r.doc_id: r.score for r in bounded} == pytest.approx(whole, abs=1e-9)
    texts = documents([(k, t) for k, t, _, _ in rows] + [(900, None), (901, "")])
    for span in (1, 3):
        full = fit_toxicity(texts, labels, "toxic", F.lit(True), span=span)
        cut = fit_toxicity(texts, labels, "toxic", F.lit(True), span=span, entries=2)
        assert full.table is None and cut.ratios is None
        assert {r.word: r.ratio for r in cut.table.collect()} == pytest.approx(full.ratios)
        shared = spark.sparkContext.broadcast(replace(cut, table=None))
        got = {r.doc_id: r.x for r in features_of(texts, cut, shared).collect()}
        given = [(k, t) for k, t, _, _ in rows] + [(900, None), (901, "")]
        want = {k: list(full.features(t)) for k, t in given}
        assert got.keys() == want.keys()
        for k, x in want.items():
            assert got[k] == pytest.approx(x)
