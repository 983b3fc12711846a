"""Exact dedup stores few files: a task that writes one starts processes."""

from pathlib import Path

import brute

from tessera.llm import exact_dedup as X
from tessera.llm.common import Scratch

SMALL = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
         "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"}


def test_exact_dedup_stores_names_in_few_files_and_no_pairs(spark, monkeypatch):
    rows = [(i, " ".join(f"w{(i % 190) * 7919 + k}" for k in range(1200))) for i in range(200)]
    saved = []

    class Counted(Scratch):
        def save(self, df, step):
            out = super().save(df, step)
            saved.append((step, len([*Path(self.path(step).removeprefix("file:")).glob("part-*")])))
            return out

    monkeypatch.setattr(X, "Scratch", Counted)
    before = {k: spark.conf.get(k) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    try:
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = [tuple(r) for r in X.exact_duplicates(docs).select("doc_id", "keep_id", "group_size", "text_sha256").collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(got) == sorted(brute.exact(rows)) and sum(i != keep for i, keep, _, _ in got) == 10
    files = dict(saved)
    assert files["names-0"] <= 4            # 16 without gathering: the blocks of 1.5 MB are dealt to 16 tasks
    assert {"names-1", "cells-1"} <= set(files) and not [s for s in files if s.startswith("pairs")]
