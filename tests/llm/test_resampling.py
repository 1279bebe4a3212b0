import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from topicflow.llm import resampling as S

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    return len(words), [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, longest, buckets=S.BUCKETS, min_words=S.MIN_WORDS, share=S.SHARE, seed=S.SEED):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    found = [(i, *features(t, longest)) for i, t in docs]
    s, t = [0] * buckets, [0] * buckets
    for _, _, fs in found:
        for f in fs:
            s[bucket(f)] += 1
    for text in target:
        for f in features(text, longest)[1]:
            t[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for i, n, fs in found:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[bucket(f)] for f in fs)
        rows.append((i, n, len(fs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranks = {}
    for k, r in enumerate(order[: share * len(order) // 100], 1):
        ranks.setdefault((r[0], r[3]), []).append(k)
    return sorted(str((i, n, w, sc, (ranks.get((i, w)) or [None]).pop(0) if ranks.get((i, w)) else None)) for i, _, n, w, sc in rows)


def corpus(n=400):
    r = random.Random(4)
    vocabulary = [f"Word{i}" for i in range(60)] + [f"rare{i}é" for i in range(900)] + ["日本", "naïve", "x" * 90]
    weights = [50] * 60 + [1] * 903
    text = lambda: r.choice([" ", "-", "\n", "_", "\t."]).join(r.choices(vocabulary, weights, k=r.randint(0, 60)))
    rows = [(i, text()) for i in range(n)]
    rows += [(5000, None), (5001, ""), (5002, "!!! \n"), (None, rows[7][1] + " more" * 30), (7, rows[7][1]), (7, rows[8][1]),
             (5003, "long Word1 " * 20000)]
    return rows, [text() for _ in range(30)] + [None, ""]


def frames(spark, docs, target):
    df = spark.createDataFrame([(i, t, 1.0, "x") for i, t in docs], "doc_id bigint, text string, weight double, rank string")
    return df, spark.createDataFrame([(t,) for t in target], "text string")


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_rows_are_those_of_brute_force_whatever_the_head(spark, longest, monkeypatch):
    monkeypatch.setattr(S, "HEAD_COUNT", 5)
    docs, target = corpus()
    df, goal = frames(spark, docs, target)
    wanted = brute(docs, target, longest, min_words=10)
    for head in (0, 20, 100_000):
        got = S.resample(df.repartition(3), goal, longest=longest, min_words=10, head=head)
        assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        assert sorted(str(tuple(r)) for r in got.collect()) == wanted


def test_the_head_holds_frequent_words_and_their_frequent_pairs(spark):
    df, _ = frames(spark, [(i, f"often seen {'twice' if i < 8 else 'ever'} n{i}") for i in range(40)], [])
    head = S.head_of(df, longest=2)
    assert head.words == {w: zlib.crc32(w) for w in (b"often", b"seen", b"ever")}
    assert head.pairs == {(a, b): zlib.crc32(a + b" " + b) for a, b in [(b"often", b"seen"), (b"seen", b"ever")]}
    assert S.head_of(df).pairs == {} and len(S.head_of(df, most=2).words) == 2


def test_forgetting_tail_words_changes_nothing(monkeypatch):
    words = [f"w{i % 50}".encode() for i in range(500)]
    whole = S.Features(S.Head({b"w1": zlib.crc32(b"w1")}, {}), 97, 2).buckets_of(words)
    monkeypatch.setattr(S, "REMEMBERED", 3)
    again = S.Features(S.Head({b"w1": zlib.crc32(b"w1")}, {}), 97, 2).buckets_of(words)
    assert np.array_equal(whole, again) and len(whole) == 999


def test_partial_counts_add_up_to_totals(spark, monkeypatch):
    monkeypatch.setattr(S, "REMEMBERED", 10)
    docs, target = corpus(100)
    df, goal = frames(spark, docs, target)
    totals = S.bucket_totals(df, S.head_of(df), 50)
    assert totals.sum() == sum(len(features(t, 1)[1]) for _, t in docs)
    assert sorted(str(tuple(r)) for r in S.resample(df, goal, buckets=50).collect()) == brute(docs, target, 1, buckets=50)


def test_sql_gives_the_same_rows(spark, tmp_path):
    docs, target = corpus()
    docs = [d for d in docs[:-4]]
    df, goal = frames(spark, docs, target)
    df.write.parquet(str(tmp_path / "d"))
    goal.write.parquet(str(tmp_path / "b"))
    db = duckdb.connect()
    db.execute(f"create view documents as select doc_id, text from '{tmp_path}/d/*.parquet'")
    db.execute(f"create view benchmark as select * from '{tmp_path}/b/*.parquet'")
    assert sorted(map(str, db.execute(S.SQL).fetchall())) == sorted(str(tuple(r)) for r in S.resample(df, goal).collect())


def test_ties_empty_tables_and_drawn(spark):
    docs = [(i, "the same twenty words " * 5) for i in range(50)] + [(3, "the same twenty words " * 5)] * 20
    df, goal = frames(spark, docs, ["other words"])
    ranks = sorted(r["rank"] for r in S.resample(df, goal, share=40).collect() if r["rank"])
    assert ranks == list(range(1, 29))
    assert S.resample(df.limit(0), goal).count() == 0
    assert S.resample(df, goal.limit(0)).count() == 70
    kept = S.drawn(df, goal, share=40)
    assert kept.columns == df.columns and 0 < kept.count() <= 28 + 20
