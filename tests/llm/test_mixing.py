import math

import duckdb

from topicflow.llm import mixing as M


def frame(spark, n=4000):
    rows = [(i, "t" * (i % 3), ["big", "big", "big", "small", None][i % 5] if i else "one", i) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, row bigint")


def test_counts_invert_the_distribution(spark):
    """The number of copies is the smallest k whose cumulative chance reaches the hashed number."""
    df = frame(spark, 600)
    rates = {r.source: r for r in M.rates(df, "source", {"small": 30.0}, None).collect()}
    for r in rates.values():
        mean = -math.log(r.cdf[0])
        total, term = 0.0, math.exp(-mean)
        for k, c in enumerate(r.cdf):
            total += term
            assert abs(c - total) < 1e-9
            term *= mean / (k + 1)
    assert rates["small"].parts >= 1 and rates["one"].parts >= 1
    us = {r.doc_id: r.u for r in df.select("doc_id", M.uniform(M.F.lit(M.SEED), M.F.col("doc_id").cast("string"), M.F.lit("1")).alias("u")).collect()}
    got = {}
    for r in M.mix(df, weights={"small": 30.0}, copy="copy").collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    for r in df.collect():
        rate = rates[r.source]
        if rate.parts == 1:
            assert got.get(r.doc_id, 0) == sum(c < us[r.doc_id] for c in rate.cdf)


def test_shares_and_repeatability(spark):
    df = frame(spark)
    mixed = M.mix(df, weights={"big": 1.0, "small": 2.0, "one": 1.0}, rows=8000)
    counts = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert 1.7 < counts["small"] / counts["big"] < 2.3
    assert 0.8 < counts["one"] / counts["big"] < 1.2  # one document, repeated by a sum of draws
    again = M.mix(df.repartition(7), weights={"big": 1.0, "small": 2.0, "one": 1.0}, rows=8000)
    assert mixed.columns == df.columns
    assert sorted(map(str, mixed.collect())) == sorted(map(str, again.collect()))
    order = [r.doc_id for r in mixed.limit(2000).collect()]
    assert order != sorted(order)


def test_the_plan_is_native(spark):
    text = M.mix(frame(spark, 50))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text


def test_sql_gives_the_same_rows(spark, tmp_path):
    df = frame(spark, 900)
    df.write.parquet(str(tmp_path / "d"))
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{tmp_path}/d/*.parquet'")
    got = M.mix(df, copy="copy").collect()
    key = lambda r: (r[0], r[-1])
    assert sorted(map(tuple, got), key=key) == sorted(db.execute(M.SQL).fetchall(), key=key)


def test_empty_zero_weights_and_repeated_rows(spark):
    df = frame(spark, 100)
    assert M.mix(df.limit(0)).count() == 0
    assert M.mix(df, weights={"big": 0.0}).where("source = 'big'").count() == 0
    twice = M.mix(df.where("source = 'big'").union(df.where("source = 'big'")), weights={"big": 1.0}, copy="copy")
    assert all(r["count"] == 2 for r in twice.groupBy("doc_id", "copy").count().collect())


def test_the_order_is_the_same_however_rows_and_tasks_are_dealt(spark):
    df, weights = frame(spark, 700), {"small": 2.0}
    order = [(r.doc_id, r.copy) for r in M.mix(df, weights=weights, copy="copy").collect()]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        again = [(r.doc_id, r.copy) for r in M.mix(df.repartition(5), weights=weights, copy="copy").collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert order == again and len(order) > 500


def test_clashing_names_and_nulls(spark):
    rows = [(None, None, None, 7)] * 3 + [(i, None, "a", 8) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, Copy int")
    wide = df.withColumns({n: M.F.lit("x") for n in ("row", "part", "nth", "key", "cdf", "parts", "u", "times")})
    mixed = M.mix(wide, copy="copy")
    assert mixed.columns == ["doc_id", "text", "source", *wide.columns[4:], "copy"]
    found = mixed.collect()
    assert all(r.copy >= 1 and r.key == "x" for r in found)
    nulls = [r.copy for r in found if r.doc_id is None]
    assert all(nulls.count(c) == 3 for c in nulls)  # rows without an id draw alike
    assert M.mix(df).columns == df.columns
