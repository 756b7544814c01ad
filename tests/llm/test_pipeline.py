import collections

import duckdb
from helpers import DOCS, corpus
from test_dedup import LOWER, brute_components

import __spark_entry__
import corpus_pipeline
from cuelark.llm import mixing, pieces, quality_rules


def test_pipeline_against_brute_force(spark, tmp_path):
    docs = spark.createDataFrame(corpus(9, 40), DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 40), 0) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    labels = spark.read.parquet(f"{tmp_path}/labels.parquet")
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    left = {r.doc_id for r in quality_rules.judged(docs, labels).where("kept").collect()}
    assert 20 < len(left) < len(text)
    groups = collections.defaultdict(list)
    for i in left:
        groups[text[i].translate(LOWER)].append(i)
    left = {max(v) for v in groups.values()}
    label = brute_components({i: text[i] for i in left}, 5, 80)[1]
    left = {i for i in left if label[i] == i}
    con = duckdb.connect()
    documents = docs.where(docs.doc_id.isin(list(left))).toPandas()  # noqa: F841  it is named in the SQL
    con.register("documents", documents)
    copies = {r[0]: r[1] for r in con.sql(f"SELECT doc_id, copies FROM ({mixing.SQL})").fetchall() if r[1]}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert collections.Counter(r.doc_id for r in out) == copies
    a = pieces.automaton(pieces.default_model())
    import numpy as np

    assert all(a.decode(np.array(r.ids, np.int32)).tobytes().decode() == text[r.doc_id] and r.n_pieces == len(r.ids) for r in out)


def test_stages_keep_the_columns(spark, tmp_path):
    docs = spark.createDataFrame(corpus(9, 10), DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_registered():
    q = __spark_entry__.queries()
    assert "pipeline" in q and all(any(n.startswith(f"op{k}_") for n in q) for k in range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= set(q)
