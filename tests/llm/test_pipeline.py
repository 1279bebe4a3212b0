"""The stages against brute force, and the registered queries on the smallest tables."""

from pathlib import Path

import duckdb
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline as P
from topicflow.llm import queries as Q
from topicflow.llm import simhash, toxicity

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


def test_every_query_is_registered():
    assert set(Q.queries()) <= set(contract.queries())
    assert sorted(Q.queries()) == sorted([q for q in contract.queries() if q.startswith("op")] + ["pipeline"])
    assert {q.split("_")[0] for q in Q.queries()} == {f"op{n}" for n in range(1, 14)} | {"pipeline"}


def test_sql(spark):
    db = duckdb.connect()
    for table in ("documents", "labels", "benchmark"):
        db.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    for name, sql in Q.oracle_sql().items():
        got, expected = Q.queries()[name](spark, SF_DIR), db.execute(sql)
        assert got.columns == [d[0] for d in expected.description]
        assert sorted(map(tuple, got.collect())) == sorted(expected.fetchall())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, labels = docs.columns, spark.read.parquet(f"{SF_DIR}/labels.parquet")
    outs, at = [], docs
    for _, stage in P.STAGES:
        at = P.stored(stage(spark, at, SF_DIR))
        outs.append(at)
    assert all(o.columns == columns for o in outs[:-1])
    rows = [o.collect() for o in outs]

    scored = {r.doc_id: r.predicted for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert sorted(r.doc_id for r in rows[0]) == sorted(i for i, p in scored.items() if not p)

    prints = {r.doc_id: simhash.fingerprint((r.text or "").encode()) for r in rows[0]}
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert sorted(r.doc_id for r in rows[1]) == sorted(i for i in prints if find(i) == i)

    before = {r.doc_id: r for r in rows[1]}
    for r in rows[2]:
        assert r.n_chars == (len(r.text) if r.text != before[r.doc_id].text else before[r.doc_id].n_chars)
    windows = {}
    for r in rows[2]:
        words = r.text.lower().split()
        for i in range(len(words) - 59):
            windows.setdefault(tuple(words[i : i + 60]), set()).add(r.doc_id)
    assert all(len(ids) == 1 for ids in windows.values())  # no passage of 60 words is left in two documents

    kept = {r.doc_id: r for r in rows[2]}
    assert all(r == kept[r.doc_id] for r in rows[3]) and len(rows[3]) == len(rows[4])

    library = Tokenizer.from_file(Q.public_tokenizers.path(P.BPE_FILE))
    for r in rows[4]:
        assert r.ids == library.encode(kept[r.doc_id].text, add_special_tokens=False).ids and r.text == kept[r.doc_id].text


def test_run_on_an_empty_table(spark, tmp_path):
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
