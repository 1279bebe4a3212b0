import random

import xxhash

from topicflow.llm import simhash as S
from topicflow.llm.graph import components


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids, linked):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def texts():
    r = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(r.choices(words, k=r.choice([1, 2, 3, 40, 300]))) for _ in range(40)]
    near = [b + " tail" for b in base] + [b.upper() for b in base]
    return [*base, *near, None, "", " \n", "É é", "one word here", "x " * 70000]


def test_fingerprints(spark):
    for text in texts()[:-1]:
        assert S.fingerprint((text or "").encode()) == brute_fingerprint(text)


def test_components_are_those_of_all_pairs(spark):
    rows = [(i, t, "c") for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, fp string")
    found = {r.doc_id: r for r in S.simhash_components(df).collect()}
    fp = {i: S.fingerprint((t or "").encode()) for i, t, _ in rows}
    expected = groups(list(fp), lambda a, b: (fp[a] ^ fp[b]).bit_count() <= 2)
    assert {i: r.component_id for i, r in found.items()} == expected
    assert {i: r.fp & (1 << 64) - 1 for i, r in found.items()} == fp
    kept = S.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in expected if expected[i] == i)


def test_both_indexes_find_the_same_components(spark):
    r = random.Random(5)
    centre = r.getrandbits(64)
    values = {centre}
    while len(values) < 300:
        x = r.choice(sorted(values))
        for _ in range(r.choice([1, 2, 2, 3])):
            x ^= 1 << r.randrange(64)
        values.add(x)
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    df = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    expected = groups(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 2)
    for bucket in (10**9, 3, 0):
        got = {r.node: r.component for r in components(S.links(df, bucket)).collect()}
        assert {v: got.get(v, v) for v in signed} == expected


def test_components_of_paths_and_hubs(spark):
    path = [(i, i + 1) for i in range(70)]
    hub = [(1000, 1000 + i) for i in range(1, 50)]
    df = spark.createDataFrame([*path, *hub, (5, 5), (None, 3), *hub], "src bigint, dst bigint")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {**dict.fromkeys(range(71), 0), **dict.fromkeys(range(1000, 1050), 1000)}


def test_empty_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert S.simhash_components(empty).count() == 0 and S.keep_first(empty).count() == 0
    twice = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, "a b c d")], "doc_id bigint, text string")
    assert sorted(map(tuple, S.simhash_components(twice).select("doc_id", "component_id").collect())) == [(1, 1), (1, 1), (2, 1)]
    assert [r.doc_id for r in S.keep_first(twice).collect()] == [1, 1]


def test_fingerprint_text(spark):
    df = spark.createDataFrame([(0,), (255,), (-1,)], "fp bigint").select(S.fingerprint_text().alias("t"))
    assert [r.t for r in df.collect()] == ["0" * 16, "0" * 14 + "ff", "f" * 16]


def test_rows_without_an_id_stay(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (1, "a b c d"), (2, "a b c d"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("text", "doc_id")
    kept = S.keep_first(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, ""), (0, "a b c d"), (0, "a b c d"), (1, "a b c d")]


def test_what_an_explode_makes_is_not_broadcast(spark):
    """Spark sizes it by the rows before."""
    df = spark.createDataFrame([(v,) for v in range(200)], "fp bigint")
    plan = S.links(df)._jdf.queryExecution().sparkPlan()
    joins = [p for p in plan.toString().splitlines() if "Join" in p and "Inner" in p]
    assert len(joins) == 2 and all("SortMergeJoin" in p for p in joins)
