"""The pipeline's stages, each on its own input, and the registered queries against their SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from strata.llm import catalog
from tests.llm import brute
from tests.llm.test_dedup import plain_line_dedup

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert out.columns == docs.columns
            assert out.where("n_chars <> length(text)").isEmpty() or name == "quality"
        seen[name] = (docs, out)
        docs = out
    before, after = seen["quality"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert before.join(labels.where("quality = 1"), "doc_id").select("doc_id").exceptAll(after.join(labels.where("quality = 1"), "doc_id").select("doc_id")).isEmpty()
    assert after.count() < before.count()
    before, after = seen["line_dedup"]
    want = plain_line_dedup(sorted((r["doc_id"], r["text"]) for r in before.collect()))
    assert {r["doc_id"]: r["text"] for r in after.collect()} == {i: t for i, (t, n) in want.items() if not n or t.strip(" ")}
    before, after = seen["near_duplicates"]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(i for i, _, c in brute.near_classes(rows, 5, 80) if c == i)
    before, after = seen["substring_dedup"]
    want = {i: (n, gone) for i, n, gone, _ in brute.repeated_words([(r["doc_id"], r["text"]) for r in before.collect()], 20)}
    got = {r["doc_id"]: r["text"] for r in after.collect()}
    source = {r["doc_id"]: r["text"] for r in before.collect()}
    for i, (n, gone) in want.items():
        assert (i in got) == (gone == 0 or gone < n)
        if i in got:
            assert got[i] == source[i] if gone == 0 else len(got[i].split()) == n - gone
    before, after = seen["packing"]
    assert {r["doc_id"] for r in before.select("doc_id").collect()} == {r["doc_id"] for r in after.select("doc_id").collect()}


def test_near_stage_keeps_one_row_of_each_class(spark):
    """Repeated rows, one id under several texts, null ids and texts without words."""
    text, other = "one two three four five six seven", "other words that stand here all alone"
    lines = " ".join(f"w{i}" for i in range(60))
    rows = [(3, text), (3, text), (None, text), (2, text.upper()),                 # a null id beside smaller ones
            (4, other), (4, other), (4, other + " "),                              # repeated rows, and the same words in other bytes
            (5, lines), (5, lines + " more"), (6, lines + " end"),                 # near copies under one id
            (7, "seven"), (7, "another seven of one id"),                          # one id in two classes
            (None, "lonely words"), (None, "lonely words"), (None, "LONELY words"), (None, "two of them"),
            (None, None), (None, None), (None, ""), (8, None), (8, " "), (9, " "), (9, " "), (0, "zero"), (None, "zero")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = P.near_stage(spark, docs, SF)
    assert got.columns == docs.columns
    kept = sorted(((r["doc_id"], (r["text"] or "").strip().lower()) for r in got.collect()), key=str)
    five = [t for i, t in kept if i == 5]
    assert len(five) == 1 and five[0] in (lines, lines + " more")
    assert [x for x in kept if x[0] != 5] == sorted(
        [(2, text), (4, other), (7, "seven"), (7, "another seven of one id"), (None, "lonely words"), (None, "two of them"),
         (None, ""), (8, ""), (8, ""), (9, ""), (0, "zero")], key=str)


def test_run_gives_the_same(spark):
    one, two = (P.run(spark, SF).groupBy("doc_id").agg(F.sum("length").alias("n")) for _ in range(2))
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty() and one.count() > 100


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("pages", "conversations", "documents", "embeddings", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.sql(catalog.ORACLE[name])
    got = catalog.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(rel.columns)
    assert sorted(map(tuple, got.select(*rel.columns).collect()), key=str) == sorted(rel.fetchall(), key=str)
