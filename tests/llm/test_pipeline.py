"""Queries next to their SQL, and the pipeline next to brute force."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.compare import compare, duck
from tests.llm import brute
from ticketry.llm.queries import QUERIES
from ticketry.llm.sql import ORACLES
from ticketry.llm.tokens import default_path, load

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    _, _, problem = compare(spark, duck(FOLDER), entry.queries()[name], ORACLES[name], FOLDER)
    assert problem is None


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names


def test_bench_times_every_training_data_query():
    import bench

    assert set(bench.OPTIONAL) == {*QUERIES, "pipeline"}


def test_pipeline(spark, tmp_path):
    result = corpus_pipeline.run(spark, FOLDER).collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    verdict = {r.doc_id: r.kept for r in entry.queries()["op10_quality_rules"](spark, FOLDER).collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if verdict[r.doc_id])
    rows = [(d, t) for (d, t), (_, _, c) in zip(rows, brute.near_duplicates(rows)) if d == c]
    tokenizer = load(default_path())[0]
    first: dict[tuple, int] = {}
    wanted = []
    for d, t in rows:
        words = t.encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - 49):
            if first.setdefault(tuple(words[i : i + 50]), d) < d:
                gone[i : i + 50] = [True] * 50
        kept = b" ".join(w for w, g in zip(words, gone) if not g).decode()
        ids = [*tokenizer.encode(kept, add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at : at + 4096], "<u4")
            wanted.append((d, piece, at, len(part), zlib.crc32(part.tobytes())))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in result) == Counter(wanted)


def test_stages_take_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        assert out.count() == 0


@pytest.mark.parametrize("stage", ["simhash_near_dedup", "substring_dedup", "best_fit_packing"])
def test_stages_hand_texts_over_by_their_size(spark, stage):
    """10,000 texts at a time, of whatever size, took more memory than an executor has."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.createDataFrame([(i, "a" * (1 << 19)) for i in range(20)], "doc_id long, text string").coalesce(1)
    before = spark.conf.get(name)
    try:
        dict(corpus_pipeline.STAGES)[stage](spark, docs, FOLDER)
        sizes = docs.mapInArrow(lambda batches: (b.slice(0, 1) for b in batches), docs.schema).count()
        assert 2 <= sizes <= 10
    finally:
        spark.conf.set(name, before)
