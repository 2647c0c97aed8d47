"""The stages of the corpus pipeline on small tables: what stays, whole rows, clashing
columns, nulls, repeated rows and empty tables."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from pulsemart.llm import neardup, sharding, toxicity

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id long, hash long, copies int, d long, h long, "
          "row string, lost boolean, score double, found string, component string, s string, c long, cut int, bucket int, p double")
CLASH = (1, 2, 3, 4, 5, "r", True, 0.5, "f", "k", "s", 6, 7, 8, 0.25)


def _docs(spark, rows):
    return spark.createDataFrame([(d, t, None, src, None, *CLASH) for d, t, src in rows], SCHEMA)


@pytest.fixture()
def tables(spark, tmp_path, monkeypatch):
    """A folder with small benchmark and labels tables."""
    spark.createDataFrame([(1, "the benchmark asks one long question that nobody should ever train on")], "item_id long, text string"
                          ).write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    monkeypatch.setattr(toxicity, "STEPS", 60)
    return str(tmp_path)


def _base(n):
    return " ".join(f"word{n}x{i}" for i in range(60))


def _prose(i):
    return f"{'vile hateful slur insult ' * 6 if i % 2 else 'kind garden summer letter ' * 6} {_base(i)}"


def _stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_every_stage_takes_empty_tables_and_clashing_columns(spark, tables):
    none, some = _docs(spark, []), _docs(spark, [(1, None, None), (2, "", "a"), (None, "x y", "a"), (3, "a b c", "b")])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, tables).count() == 0
        out = stage(spark, some, tables)
        out.collect()
        if name != "sharding":
            assert out.columns == some.columns
            assert {tuple(r)[5:] for r in out.collect()} <= {CLASH}


def test_toxicity_keeps_whole_rows_of_clean_documents(spark, tables):
    docs = _docs(spark, [(i, _prose(i), "a") for i in range(120)])
    scores = {r["doc_id"]: r["score"] for r in toxicity.toxicity(
        docs, spark.read.parquet(f"{tables}/labels.parquet")).collect()}
    kept = _stage("toxicity")(spark, docs, tables).collect()
    assert {r["doc_id"] for r in kept} == {d for d, s in scores.items() if s < toxicity.THRESHOLD}
    assert 40 < len(kept) < 80


def test_one_row_of_each_group_of_near_copies_stays(spark, tables):
    near = _base(1).replace("word1x7 ", "")
    rows = [(7, _base(1), "a"), (7, near, "a"), (7, near + " more", "a"), (7, near, "a"),      # linked rows that share an id
            (3, _base(2), "a"), (9, _base(2), "b"), (3, _base(2), "a"), (4, _base(3), "a"),
            (None, _base(4), "a"), (None, _base(4) + " end", "a"), (5, None, "a"), (6, "", "a"), (6, "", "a")]
    docs = _docs(spark, rows)
    kept = [(r["doc_id"], r["text"]) for r in _stage("minhash_near_dedup")(spark, docs, tables).collect()]
    ids = Counter(d for d, _ in kept)
    assert ids == {7: 1, 3: 1, 4: 1, None: 1, 5: 1, 6: 2}
    again = [(r["doc_id"], r["text"]) for r in _stage("minhash_near_dedup")(spark, docs.repartition(5), tables).collect()]
    assert Counter(kept) == Counter(again)
    found = neardup.near_duplicates(docs).filter("doc_id = 7").collect()
    assert len({r["component"] for r in found}) == 1


def test_benchmark_windows_drop_whole_rows(spark, tables):
    leak = "and then The Benchmark asks one long question that nobody should EVER train on today"
    docs = _docs(spark, [(1, leak, "a"), (2, leak.replace("nobody", "somebody"), "a"), (3, None, "a"), (4, "clean", "a")])
    assert {r["doc_id"] for r in _stage("decontamination")(spark, docs, tables).collect()} == {2, 3, 4}


def test_sharding_is_the_last_stage(spark, tables):
    docs = _docs(spark, [(i, "x" * (i % 50), "a") for i in range(500)])
    out = _stage("sharding")(spark, docs, tables)
    assert out.count() == 500 and {r["shard"] for r in out.select("shard").collect()} == set(range(corpus_pipeline.N_SHARDS))
    assert sharding.OVERHEAD_BYTES == 8
