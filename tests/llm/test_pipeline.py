"""Registered queries, and the pipeline against a version in plain Python."""

import hashlib
import os
from collections import defaultdict

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from chesstally.llm import decontam, queries, quality
from tests.conftest import SF_SMALL
from tests.llm.test_decontam import sellers
from tests.llm.test_dedup import brute_fp, brute_lines, components


def test_names():
    names = list(entry.queries())
    assert [n for n in names if n[:2] == "op" and n[2:3].isdigit()] == [
        next(q for q in queries.QUERIES if q.startswith(f"op{i}_")) for i in range(1, 14)]
    assert "pipeline" in names and set(entry.oracle_sql()) >= set(queries.ORACLE_SQL)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "SimHash near-dedup", "benchmark decontamination",
        "BPE encoding and decoding"]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF_SMALL)
    want = con.sql(queries.ORACLE_SQL[name])
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())


def test_every_query_gives_a_row_per_document(spark):
    n = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    for name, q in queries.QUERIES.items():
        out = q(spark, SF_SMALL)
        if name.split("_")[0] == "op12":
            want = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id").distinct().count()
            assert out.count() == out.select("conv_id").distinct().count() == want
        elif name.split("_")[0] not in ("op6", "op10", "op13"):
            rows = out.select("doc_id").collect()
            assert len(rows) == len({r.doc_id for r in rows}) == n, name
        else:
            assert out.count() > 0


def plain_pipeline(docs, good, bench, tok):
    """``docs``: (doc_id, text, source) rows; ``good``: the classifier's verdict on a text."""
    docs = [d for d in docs if good[d[1] or ""]]
    assert sum(i is None for i, _, _ in docs) <= 1
    cleaned = {i: t for i, t, _, _ in brute_lines(docs, 3)}
    docs = [(i, cleaned[str(i)], s) for i, _, s in docs]
    docs = [(i, None if t == "None" else t, s) for i, t, s in docs]
    fps = [brute_fp(t) for _, t, _ in docs]
    comp = components(len(docs), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    ids = defaultdict(list)
    for (i, _, _), c in zip(docs, comp):
        if i is not None:
            ids[c].append(i)
    docs = [d for d, c in zip(docs, comp) if d[0] is None or d[0] == min(ids[c])]
    items = [x for x in map(decontam.normalise, bench) if x]

    def leaks(text):
        t = decontam.normalise(text)
        # A plain search first: the dynamic programme over every pair would take hours.
        return any(x in t or any(p in t for _, p in decontam.pieces(x)) and sellers(x, t) <= len(x) // 16
                   for x in items)

    out = []
    for i, t, _ in docs:
        if not leaks(t):
            enc = tok.encode(t or "", add_special_tokens=False).ids
            dec = tok.decode(enc, skip_special_tokens=False)
            out.append((str(i), len(enc), hashlib.sha256(" ".join(map(str, enc)).encode()).hexdigest(),
                        hashlib.sha256(dec.encode()).hexdigest()))
    return sorted(out)


def compare(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]
    texts = sorted({t or "" for _, t, _ in rows})
    good = dict(zip(texts, model.score_all(texts) >= 0.5))
    bench = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = plain_pipeline(rows, good, bench, Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")))
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted((str(r.doc_id), *r[1:]) for r in got.collect()) == want
    return len(rows), len(want)


def test_pipeline_on_the_small_tables(spark):
    before, after = compare(spark, SF_SMALL)
    assert 0 < after < before


def test_pipeline_on_odd_rows(spark, tmp_dir):
    """Nulls in every column, empty texts, ties, and a column with a clashing name."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60)
    one = docs.orderBy("doc_id").limit(1)
    n = F.lit(None).cast("long")
    odd = (docs.unionByName(one.withColumn("doc_id", F.lit(9001).cast("long")).withColumn("source", F.lit(None).cast("string")))
           .unionByName(one.withColumn("doc_id", F.lit(9002).cast("long")).withColumn("text", F.lit(None).cast("string")))
           .unionByName(one.withColumn("doc_id", F.lit(9003).cast("long")).withColumn("text", F.lit("")))
           .unionByName(one.withColumn("doc_id", n).withColumn("n_chars", n))
           .withColumn("lines_removed", F.lit("x")).withColumn("score", F.lit(1)))
    odd.write.parquet(os.path.join(tmp_dir, "documents.parquet"))
    for t in ("labels", "benchmark"):
        df = spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
        df.unionByName(df.limit(1).select(*[F.lit(None).cast(d).alias(c) for c, d in df.dtypes])).write.parquet(
            os.path.join(tmp_dir, f"{t}.parquet"))
    # one id on two texts, and a very long text
    text = " ".join(r.text or "" for r in docs.select("text").collect())
    long = (odd.unionByName(one.withColumn("text", F.lit("another text under an id that is there")), allowMissingColumns=True)
            .unionByName(one.withColumn("doc_id", F.lit(9004).cast("long")).withColumn("text", F.lit(text * 12)),
                         allowMissingColumns=True))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, tmp_dir)
        assert out.columns == odd.columns, name
        assert stage(spark, long, tmp_dir).columns == odd.columns
        assert stage(spark, odd.where("1 = 0"), tmp_dir).count() == 0
    compare(spark, tmp_dir)
