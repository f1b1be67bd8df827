"""The pipeline's stages against plain Python versions, each on its own input, and run() as a whole."""

import duckdb
import pytest

from tests.llm import brute

corpus_pipeline = pytest.importorskip("corpus_pipeline")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def texts(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["toxicity", "simhash", "decontaminate", "mixing", "sharding"]

    calm = corpus_pipeline.written(stage["toxicity"](spark, docs, sf_dir))
    toxic = {d for d, t in duckdb.sql(f"select doc_id, toxic from '{sf_dir}/labels.parquet'").fetchall() if t}
    gone = set(r.doc_id for r in docs.collect()) - set(r.doc_id for r in calm.collect())
    assert calm.columns == COLUMNS and 0 < len(gone) < 0.3 * docs.count()
    assert len(gone & toxic) > 0.5 * len(toxic)

    rows = texts(calm)
    unique = corpus_pipeline.written(stage["simhash"](spark, calm, sf_dir))
    want = {d for (d, _), c in zip(rows, brute.near_copies(rows)) if c == d}
    assert unique.columns == COLUMNS and {d for d, _ in texts(unique)} == want

    clean = corpus_pipeline.written(stage["decontaminate"](spark, unique, sf_dir))
    bench = duckdb.sql(f"select item_id, text from '{sf_dir}/benchmark.parquet'").fetchall()
    want = [d for d, *_, bad in brute.decontaminate(texts(unique), bench) if not bad]
    assert clean.columns == COLUMNS and [d for d, _ in texts(clean)] == sorted(want)

    mixed = corpus_pipeline.written(stage["mixing"](spark, clean, sf_dir))
    size = {d: len(brute.NOT_SPACE.findall(t)) for d, t in texts(clean)}
    total = sum(size.values())
    assert mixed.columns == COLUMNS and set(texts(mixed)) <= set(texts(clean))
    assert abs(sum(size[d] for d, _ in texts(mixed)) - 1.5 * total) < 0.03 * total

    out = stage["sharding"](spark, mixed, sf_dir)
    got = out.collect()
    assert out.columns == [*COLUMNS, "shard", "slot"] and sorted((r.doc_id, r.text) for r in got) == texts(mixed)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and max(map(len, by.values())) - min(map(len, by.values())) <= 1


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == [*COLUMNS, "shard", "slot"] and out.count() > 0


def test_odd_rows(spark, sf_dir):
    """Nulls, repeated rows, one id with two texts and extra columns through all stages."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40)
    odd = spark.createDataFrame([(None, "no id", None, None, None), (None, None, "en", "a", 0), (70_001, "one two three four five six", "en", None, 1), (70_001, "another text of this id", "en", "b", 1), (70_002, "twice", "en", "b", 1), (70_002, "twice", "en", "b", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.unionByName(odd.select(*[F.col(c).cast(t) for c, t in docs.dtypes])).withColumns({"row": F.lit(1), "d": F.lit("x"), "size": F.lit(2.5), "slot": F.lit(7), "print": F.lit("p"), "__size": F.lit(4)})
    docs = corpus_pipeline.written(docs)
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.written(stage(spark, docs, sf_dir))
        assert docs.columns[: len(before.columns)] == before.columns
        assert {tuple(r) for r in docs.select("row", "d", "size", "slot", "print", "__size").collect()} == {(1, "x", 2.5, 7, "p", 4)}
        if name == "simhash":
            kept = [(r.doc_id, r.text) for r in docs.filter("doc_id is null or doc_id > 70000").collect()]
            assert {(None, "no id"), (70_001, "another text of this id"), (70_001, "one two three four five six")} <= set(kept) and kept.count((70_002, "twice")) == 1


def test_empty(spark, sf_dir):
    none = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf_dir).count() == 0
