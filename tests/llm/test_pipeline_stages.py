"""The five stages on small tables, against plain versions of what each must keep."""

from __future__ import annotations

import random

import corpus_pipeline
from pyspark.sql import functions as F

from tidecast.llm.common import materialize


def small_world(spark, path):
    rng = random.Random(12)
    rows, labels = [], []
    for k in range(240):
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(70)]
        good = k % 4 != 0
        text = " ".join(words) + "." if good else (words[0] + " ") * 70
        rows.append((k, text, rng.choice(["en", "de"]), f"src{k % 12}", len(text)))
        labels.append((k, int(good), 0))
    for k in range(240, 260):  # exact copies, but for case, and near copies of good texts
        text = rows[k - 239][1]
        words = text.split()
        words[35] = "changed"
        rows.append((k, text.upper() if k % 2 else " ".join(words), "en", "src1", len(text)))
    rows += [(260, None, None, None, None), (261, "", "en", "src0", 0)]
    documents = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"
    )
    documents.withColumn("mix_epoch", F.lit("own")).write.parquet(f"{path}/documents.parquet")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    known.write.parquet(f"{path}/labels.parquet")
    return {k: t for k, t, *_ in rows}


def test_stages(spark, tmp_path):
    texts = small_world(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact", "jaccard", "mixing", "packing"]
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, str(tmp_path)), f"test-{name}")
        if name != "packing":
            assert out.columns == docs.columns
            kept.append({r.doc_id for r in out.select("doc_id").collect()})
            docs = out
    good, exact, near, mixed = kept
    assert sum(k % 4 != 0 for k in good if k < 240) >= 170 and not any(k % 4 == 0 for k in good if k < 240)
    by_text: dict[str, int] = {}
    for k in good:
        key = (texts[k] or "").lower()
        by_text[key] = max(k, by_text.get(key, -1))
    assert exact == set(by_text.values())

    def shingles(k):
        w = (texts[k] or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())

    sets = {k: shingles(k) for k in exact}
    gone = {
        a
        for a in exact
        for b in exact
        if b < a and sets[a] and sets[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])
    }
    assert near == exact - gone  # groups of two here, so the smaller id stays
    assert mixed <= near and mixed
    packed = {r.doc_id for r in out.collect()}
    assert packed == mixed
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == packed
