from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cartulary.llm import mixing, toxicity
from tests.llm.test_dedup import bare, brute_components, brute_fingerprint, words


def _write(spark, d, docs, items, labels):
    docs.write.parquet(f"{d}/documents.parquet")
    items.write.parquet(f"{d}/benchmark.parquet")
    labels.write.parquet(f"{d}/labels.parquet")


def _key(r):
    return (r[0] is None, r[0] or 0)


def _without_copies(rows):
    groups = {}
    for r in rows:
        groups.setdefault(bare(r[1]), []).append(r)
    return [min(g, key=lambda r: (-len(r[1] or ""), _key(r))) for g in groups.values()]


def _without_near_copies(rows):
    prints = [brute_fingerprint(r[1]) for r in rows]
    roots = brute_components(prints)
    groups = {}
    for r, p in zip(rows, prints):
        groups.setdefault(roots[p], []).append((_key(r), p if p < 1 << 63 else p - (1 << 64), r))
    return [min(g, key=lambda x: x[:2])[2] for g in groups.values()]


def _without_leaks(rows, items):
    grams = set()
    for _, text in items:
        w = words(text)
        grams |= {tuple(w[i : i + 10]) for i in range(max(len(w) - 9, 1) if w else 0)}

    def leaks(text):
        w = words(text)
        return any(tuple(w[i : i + len(g)]) == g for g in grams for i in range(len(w) - len(g) + 1))

    return [r for r in rows if not leaks(r[1])]


def test_pipeline_agrees_with_brute_force(spark, tmp_path, docs, rows, items):
    d = str(tmp_path)
    _write(spark, d, docs, items, spark.createDataFrame([(i, 0) for i in range(60)], "doc_id long, toxic int"))
    current, expected = spark.read.parquet(f"{d}/documents.parquet"), [r[:4] for r in rows]
    tested = [tuple(r) for r in items.collect()]
    steps = [lambda x: x, _without_copies, _without_near_copies, lambda x: _without_leaks(x, tested)]
    for (name, stage), brute in zip(corpus_pipeline.STAGES, steps):
        current = stage(spark, current, d)
        assert current.columns == docs.columns, name
        current.write.parquet(f"{d}/{name}")
        current, expected = spark.read.parquet(f"{d}/{name}"), brute(expected)
        got = [tuple(r)[:4] for r in current.collect()]
        assert Counter(r[:2] for r in got) == Counter(r[:2] for r in expected), name
        expected = got  # of rows that agree in id and text any one stays
    sizes = Counter()
    for r in expected:
        sizes[r[3]] += len((r[1] or "").split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + ([None] if None in sizes else [])
    goals = dict(zip(order, mixing.targets([sizes[s] for s in order], mixing.cyclic_weights(len(order)))))
    got = corpus_pipeline.run(spark, d).collect()
    assert Counter((r.doc_id, r.source, r["size"], r.source_size) for r in got) == Counter((r[0], r[3], len((r[1] or "").split()), sizes[r[3]]) for r in expected)
    for s in order:
        mine = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in mine) - goals[s]) <= 0.5 and all(r.taken <= 3 * r["size"] for r in mine)


def test_toxicity_stage_drops_what_the_thresholds_reject(spark):
    rng = random.Random(2)
    pool = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(300)]
    rows = [(i, " ".join([*rng.choices(pool, k=30), *(["nitwit"] if i % 4 == 0 else [])]), ["en", "de", None][i % 3]) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({c: F.lit(1) for c in ("score", "rejected", "toxic")})
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(900)], "doc_id long, toxic int").withColumn("text", F.lit("x"))
    scored = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    kept = {r.doc_id for r in toxicity.drop_toxic(docs, labels).collect()}
    assert kept == {r.doc_id for r in scored if not r.rejected}
    assert np.mean([(r.doc_id in kept) == (r.doc_id % 4 > 0) for r in scored]) > 0.97


@pytest.mark.parametrize("empty_tables", [("documents",), ("benchmark", "labels"), ("documents", "benchmark", "labels")])
def test_pipeline_of_empty_tables(spark, tmp_path, docs, items, empty_tables):
    tables = {"documents": docs, "benchmark": items, "labels": spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")}
    some = {n: t.limit(0) if n in empty_tables else t for n, t in tables.items()}
    _write(spark, str(tmp_path), some["documents"], some["benchmark"], some["labels"])
    n = corpus_pipeline.run(spark, str(tmp_path)).count()
    assert n == 0 if "documents" in empty_tables else n > 70
