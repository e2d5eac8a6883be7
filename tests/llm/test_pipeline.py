"""The stages against plain versions of each, on their own inputs, and whole."""

import datetime
import decimal
import hashlib

import duckdb
import numpy as np
import public_tokenizers
import tiktoken
import pandas as pd
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from cohortloom.llm import bpe, spaced_seeds
from test_bagminhash import bag, brute_classes
from test_suffix_dedup import plain

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain_run(rows, items):
    """doc_id to ids of the documents that stay, by loops."""
    rows = [r for r in rows if regex.search(r"\p{L}", r[1] or "")]
    found = brute_classes(rows)
    kept, seen = [], set()
    for (key, text), c in sorted(zip(rows, found)):
        if bag(text) is None or c not in seen:
            kept.append((key, text))
            seen.add(c)
    cut = [(k, left.decode("utf-8", "ignore")) for k, _, _, _, left in plain(kept, 100)]
    con = duckdb.connect()
    documents, benchmark = (pd.DataFrame(x, columns=[c, "text"]) for x, c in ((cut, "doc_id"), (items, "item_id")))
    con.register("documents", documents)
    con.register("benchmark", benchmark)
    leaks = {r[0] for r in con.execute(spaced_seeds.oracle_sql()).fetchall()}
    ranks = bpe.read_ranks(public_tokenizers.path(corpus_pipeline.RANKS))
    coder = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return {k: coder.encode_ordinary(t) for k, t in cut if k not in leaks}


def check(rows, wanted):
    assert {r.doc_id for r in rows} == wanted.keys() and len(rows) == len(wanted)
    for r in rows:
        packed = np.array(wanted[r.doc_id], "<u4").tobytes()
        assert bytes(r.ids) == packed and r.n_tokens == len(wanted[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(packed).hexdigest()


def test_whole_run(spark):
    sf_dir = "/root/testdata/sf0.001"
    table, items = ([tuple(r) for r in spark.read.parquet(f"{sf_dir}/{t}.parquet").select(k, "text").collect()]
                    for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    wanted = plain_run(table, items)
    assert len(wanted) < len(table)
    check(corpus_pipeline.run(spark, sf_dir).collect(), wanted)


def test_odd_rows_and_columns(spark, tmp_path):
    item = " ".join(f"exam{i}" for i in range(20))
    body = " ".join(f"wörd{i}" for i in range(60))
    other = " ".join(f"thing{i}" for i in range(60))
    rows = [
        (1, None), (2, ""), (3, "123 !!"), (4, body), (5, body), (6, body + " end"), (7, other), (7, other),
        (None, "nothing like it at all " * 3), (8, "start " + item + " stop"), (9, other[:200] + " x" * 40),
    ]
    cells = [(k, t, "en", "s", 5, "row", 0.5, "b") for k, t in rows]
    extra = "doc_id long, text string, lang string, source string, n_chars long, more string, score double, bag string"
    df = spark.createDataFrame(cells, extra)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    steps = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == df.columns and docs.dtypes == df.dtypes
        docs = spark.createDataFrame(docs.collect(), df.schema)
        steps.append(sorted((r.doc_id or 0) for r in docs.collect()))
    assert steps == [[0, 4, 5, 6, 7, 7, 8, 9], [0, 4, 7, 8, 9], [0, 4, 7, 8, 9], [0, 4, 7, 9]]
    found = {r.doc_id: r for r in docs.collect()}
    # The id decides what came earlier: 9 loses what it shares with 7; other columns stay.
    assert found[9].text == " x" * 40 and found[9].n_chars == 80 and found[9].more == "row" and found[9].score == 0.5
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0) for r in rows) == [0, 4, 7, 9]


def test_replacement_characters_stay_and_cuts_take_whole_characters(spark, tmp_path):
    shared = "".join(f"part {i} " for i in range(30))
    # The second text shares the last byte of é (C3 A9) with © (C2 A9), and the first of é with è.
    texts = ["head � only", "one é" + shared + "é tail", "two � ©" + shared + "è end �"]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], schema)
    rows = sorted(corpus_pipeline.suffix_array_dedup(spark, docs, str(tmp_path)).collect())
    assert [r.text for r in rows] == [*texts[:2], "two �  end �"]
    assert [r.n_chars for r in rows] == [len(r.text) for r in rows]


def test_columns_keep_types_and_names(spark, tmp_path):
    shared = "".join(f"part {i} " for i in range(40))
    when = datetime.datetime(2024, 2, 29, 1, 2, 3, 456789)
    cells = (when, when.date(), decimal.Decimal("1.50"), {1: "a", 2: None}, [None, 2.5], (b"\x00\xff", None), None)
    rows = [(1, "head " + shared, *cells), (2, shared + "tail", *cells), (3, "wholly different words", *cells[:3], None, None, None, 7)]
    schema = (
        "doc_id long, text string, row_key timestamp_ntz, language date, Lead decimal(9,2), more map<int,string>,"
        " `a.b` array<double>, pack struct<`x y`: binary, z: int>, __row long"
    )
    docs = spark.createDataFrame(rows, schema)
    docs = docs.withColumn("at", F.lit("1969-12-31 23:59:59.000001").cast("timestamp"))
    docs = docs.withColumn("lang", F.lit("en"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, str(tmp_path))
        assert found.columns == docs.columns and found.dtypes == docs.dtypes, name
        wanted = {r.doc_id: tuple(r) for r in docs.collect()}
        for r in found.collect():
            assert (r[0], *r[2:]) == (wanted[r.doc_id][0], *wanted[r.doc_id][2:]), name
            assert r.text == (wanted[r.doc_id][1] if name != "suffix_array_dedup" or r.doc_id != 2 else "tail"), name


def test_table_of_id_and_text(spark, tmp_path):
    shared = "".join(f"part {i} " for i in range(40))
    docs = spark.createDataFrame([(1, "head " + shared), (2, shared + "tail"), (2, None)], "doc_id long, text string")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = corpus_pipeline.suffix_array_dedup(spark, docs, str(tmp_path))
    assert sorted(tuple(r) for r in found.collect()) == [(1, "head " + shared), (2, ""), (2, "tail")]
    kept = corpus_pipeline.near_dedup(spark, docs, str(tmp_path)).collect()
    assert sorted(map(str, kept)) == sorted(map(str, docs.where("doc_id = 1 OR text IS NULL").collect()))
    assert sorted(map(str, corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect())) == sorted(map(str, docs.collect()))


def test_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
