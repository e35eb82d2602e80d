"""The pipeline's stages on the smallest tables, each held against plain Python on its own input."""

import os
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from cases import EDGE, edge_docs

import corpus_pipeline
from ledgerlake.llm import neardup, packing, pii, queries, token_counts
from ledgerlake.llm.common import stored

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are absent")


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, toxic = docs.columns, {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").filter("toxic = 0").collect()}
    states = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), name)
        states.append(docs.collect())
        assert name == "packing" or docs.columns == columns
    given, calm, single, clean, redacted, packed = states
    kept = {r.doc_id for r in calm}
    assert len(kept & toxic) > 0.95 * len({r.doc_id for r in given} & toxic)

    sets = [set(s.tolist()) for s in neardup.shingle_sets(pa.array([r.text for r in calm], pa.string()), 5)]
    order = sorted(range(len(calm)), key=lambda i: calm[i].doc_id)
    root = {}
    for i in order:
        root[i] = i
        for j in [j for j in order if j in root and j != i]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                low, high = sorted((root[i], root[j]), key=lambda x: calm[x].doc_id)
                root = {k: low if v == high else v for k, v in root.items()}
    assert {r.doc_id for r in single} == {calm[i].doc_id for i in root if root[i] == i}

    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert any(t in r.text for r in single for t in items) and not any(t in r.text for r in clean for t in items)
    assert len(clean) > 0.9 * len(single)
    assert {r.doc_id: r.text for r in redacted} == {r.doc_id: pii.redact(r.text) for r in clean}
    path = packing.public_tokenizers.path(packing.TOKENIZER)
    tokens = {r.doc_id: token_counts.tokenizer(path).encode(r.text, add_special_tokens=False).ids + [packing.END] for r in redacted}
    assert {(r.doc_id, r.start, r.ids_crc32) for r in packed} == {(i, s, zlib.crc32(np.array(x[s : s + 4096], "<u4").tobytes())) for i, x in tokens.items() for s in range(0, len(x), 4096)}


def test_edge_rows_and_empty_tables(spark, tmp_path):
    for rows in (EDGE, []):
        folder = f"{tmp_path}/{len(rows)}"
        edge_docs(spark, rows).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        packed = corpus_pipeline.run(spark, folder).collect()
        # 5 is repeated and 8 copies 7: one of each stays.
        assert {r.doc_id for r in packed} == ({0, 1, 2, 3, 4, 5, 6, 7, 9, None} if rows else set())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_twins(spark, name):
    con = duckdb.connect()
    for name_of in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {name_of} AS SELECT * FROM '{FOLDER}/{name_of}.parquet'")
    cursor = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in cursor.description]
    frame = queries.QUERIES[name](spark, FOLDER)
    assert sorted(frame.columns) == sorted(columns)
    assert sorted(tuple(r[c] for c in columns) for r in frame.collect()) == sorted(cursor.fetchall())
