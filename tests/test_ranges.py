"""Ranges, masks and running sums against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from topicflow import Subscription, Topic, backlog, eligible, publish, pull_messages, read_messages, read_topic
from topicflow.operators import oldest as O
from topicflow.operators import prefix, state
from topicflow.operators.delivery import ack_keys, ack_ranges
from topicflow.operators.maintenance import compact_acks
from topicflow.operators.state import Hidden, at_most, merged_ranges, ranges_of, read_acks, without
from topicflow.schema import FILE_KEY, KEY, ROWS

NOW = 1_000_000


def islands(rows, block):
    """Sets of rows a file as maximal ranges that cross no border of a block."""
    out = set()
    for file, positions in rows.items():
        for p in positions:
            if p - 1 not in positions or p % block == 0:
                end = p + 1
                while end in positions and end % block:
                    end += 1
                out.add((*file, p, end))
    return out


def random_rows(seed, size=400):
    r = random.Random(seed)
    files = [("a", "f1"), ("a", "f2"), ("b", "f1")]
    return {f: {p for p in range(size) if r.random() < share} for f, share in zip(files, (0.9, 0.4, 0.02))}


@pytest.mark.parametrize("block", [1 << 20, 64, 7])
def test_keys_become_the_fewest_ranges(spark, monkeypatch, block):
    monkeypatch.setattr(state, "BLOCK", block)
    rows = random_rows(1)
    keys = [(*f, p) for f, ps in rows.items() for p in ps] * 2
    random.Random(2).shuffle(keys)
    df = spark.createDataFrame(keys, "publish_id string, file_name string, position bigint")
    got = [tuple(r) for r in ranges_of(df).select(*ROWS).collect()]
    assert len(got) == len(set(got)) and set(got) == islands(rows, block)


@pytest.mark.parametrize("block", [1 << 20, 50])
def test_overlapping_ranges_are_merged(spark, monkeypatch, block):
    monkeypatch.setattr(state, "BLOCK", block)
    r, ranges, rows = random.Random(3), [], {}
    for file in (("a", "f1"), ("b", "f2")):
        for _ in range(40):
            low = r.randrange(900)
            high = low + r.choice([0, 1, 2, 5, 60, 130])
            ranges.append((*file, low, high))
            rows.setdefault(file, set()).update(range(low, high))
    df = spark.createDataFrame(ranges, "publish_id string, file_name string, from_row bigint, to_row bigint")
    got = [tuple(r) for r in merged_ranges(df).collect()]
    assert len(got) == len(set(got)) and set(got) == islands(rows, block)


def test_masks_hide_and_count_exactly(spark):
    r, ranges, rows = random.Random(4), [], {}
    for file in (("a", "f1"), ("b", "f2")):
        for low, high in [(0, 64), (63, 65), (128, 256), (250, 251), (300, 300), *((x, x + r.randrange(90)) for x in r.sample(range(300, 900), 6))]:
            ranges.append((*file, low, high))
            rows.setdefault(file, set()).update(range(low, high))
    df = spark.createDataFrame(ranges, "publish_id string, file_name string, from_row bigint, to_row bigint")
    hidden = Hidden(df, disjoint=False)
    assert {(c.publish_id, c.file_name): c.hidden for c in hidden.counts().collect()} == {f: len(s) for f, s in rows.items()}
    messages = spark.createDataFrame(
        [(*f, p) for f in [*rows, ("a", "f9")] for p in range(1000)], "publish_id string, file_name string, position bigint"
    )
    left = {tuple(r) for r in without(messages, hidden.masks()).collect()}
    assert left == {(*f, p) for f in [*rows, ("a", "f9")] for p in range(1000) if p not in rows.get(f, ())}
    assert without(messages, Hidden(None, True).masks()).count() == 3000 and Hidden(None, True).counts() is None


def fill(spark, root, n=300, parts=3, publish_id="p"):
    df = spark.range(0, n, 1, parts).select(
        F.col("id").cast("string").alias("m"), F.repeat(F.lit("x"), (F.col("id") % 7).cast("int")).alias("d"),
        F.timestamp_millis("id").alias("t"),
    )
    publish(df, root=root, topic="t", publish_id=publish_id, payload="d", message_id="m", publish_time="t")
    return {"root": root, "topic": "t", "subscription": "s"}


def numbers(df):
    return sorted(int(r.message_id) for r in df.select("message_id").collect())


def test_an_ack_of_neighbours_is_one_row_and_compaction_joins_acks(spark, root):
    options = fill(spark, root, parts=1)
    sub = Subscription.of(options)
    for i in range(3):
        pull = pull_messages(spark, max_messages=40, as_of=NOW, **options)
        pull.ack()
        pull.ack()
    assert sorted((r.from_row, r.to_row) for r in read_acks(spark, sub).collect()) == [(0, 40), (40, 80), (80, 120)]
    compact_acks(spark, sub)
    assert [(r.from_row, r.to_row) for r in read_acks(spark, sub).collect()] == [(0, 120)]
    assert numbers(eligible(spark, sub, NOW)) == list(range(120, 300))


def test_acks_that_overlap_count_once(spark, root):
    options = fill(spark, root, parts=1)
    sub = Subscription.of(options)
    name = read_topic(spark, sub.topic, positions=True).select(*FILE_KEY).first()
    table = lambda *rows: spark.createDataFrame([(*name, *r) for r in rows], "publish_id string, file_name string, from_row bigint, to_row bigint")
    ack_ranges(table((0, 10), (5, 20), (20, 30), (7, 7)), sub, ack_id="one")
    assert Hidden.of(spark, sub, NOW).disjoint and backlog(spark, sub, NOW).first().messages == 270
    ack_ranges(table((25, 40)), sub, ack_id="two")
    keys = read_topic(spark, sub.topic, positions=True).where("position between 30 and 49").select(*KEY)
    ack_keys(keys, sub, ack_id="three")
    assert not Hidden.of(spark, sub, NOW).disjoint
    row = backlog(spark, sub, NOW).first()
    assert (row.messages, row.oldest_publish_timestamp) == (250, 50)
    ack_ranges(table((50, 300)), sub, ack_id="four")
    assert [r.publish_id for r in compact_acks(spark, sub).collect()] == ["p"]
    assert eligible(spark, sub, NOW).isEmpty()


@pytest.mark.parametrize("seed", range(3))
def test_first_rows_within_bounds(spark, tmp_path, seed):
    r = random.Random(seed)
    rows = [(i, r.choice([0, 1, 5, 100])) for i in r.sample(range(10_000), 700)]
    df = spark.createDataFrame(rows, "k bigint, w bigint").withColumn("one", F.lit(1).cast("bigint")).repartition(5)
    ordered = sorted(rows)
    for j, (n, bound) in enumerate([(0, 0), (10, 10**9), (700, 9000), (10**6, 10**9), (350, 9100), (699, 4)]):
        taken, total, want = 0, 0, []
        for k, w in ordered:
            if want and (taken + 1 > n or total + w > bound):
                break
            want, taken, total = [*want, k], taken + 1, total + w
        got = prefix.up_to(df, ["k"], {"one": n, "w": bound}, str(tmp_path / f"{j}"))
        assert sorted(x.k for x in got.collect()) == want, (n, bound)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_files_of_a_pull_out_of_a_hundred_thousand(spark, tmp_path, monkeypatch):
    files = spark.range(0, 100_000, 1, 8).selectExpr(
        "concat('p', id % 50) as publish_id", "concat('f', id) as file_name", "(id * 7919) % 100000 as first_micros",
        "(id * 7919) % 100000 + id % 500 as last_micros", "id % 4 as waiting",
    )
    rows = files.collect()
    assert at_most(files) is None
    for j, n in enumerate((1, 5000, 149_999, 10**9)):
        held, end = 0, None
        for r in sorted(rows, key=lambda r: (r.last_micros, r.publish_id, r.file_name)):
            held += r.waiting
            if held >= n:
                end = r.last_micros
                break
        found, got = O.cut_files(files, n, str(tmp_path / str(j)))
        want = {(r.publish_id, r.file_name) for r in rows if end is None or r.first_micros <= end}
        assert got == end
        if found.rows is None:
            assert {tuple(r) for r in found.table.collect()} == want and len(want) > state.FILES_AT_ONCE
        else:
            assert {(r.publish_id, r.file_name) for r in found.rows} == want


def test_sums_are_not_made_in_one_task(spark, tmp_path):
    """A running sum is over one range, never over a window without a partition."""
    df = spark.range(1000).selectExpr("id as k", "1L as w")
    text = plan(prefix.up_to(df, ["k"], {"w": 333}, str(tmp_path / "a")))
    assert "Window" in text and "SinglePartition" not in text and "_range" in text[text.index("Window") :]


@pytest.mark.parametrize("n", [1, 10, 47, 300])
def test_more_files_than_the_driver_names_are_joined(spark, root, monkeypatch, n):
    options = fill(spark, root, parts=9)
    sub = Subscription.of(options)
    ack_keys(read_topic(spark, sub.topic, positions=True).where("message_id % 5 = 0").select(*KEY), sub, ack_id="x")
    want = [i for i in range(300) if i % 5]
    monkeypatch.setattr(state, "FILES_AT_ONCE", 2)
    assert numbers(read_messages(spark, max_messages=n, as_of=NOW, **options)) == want[:n]
    assert numbers(eligible(spark, sub, NOW)) == want
    row = backlog(spark, sub, NOW).first()
    assert (row.messages, row.oldest_publish_timestamp) == (240, 1)
    pull = pull_messages(spark, max_messages=n, as_of=NOW, **options)
    assert numbers(pull.messages) == want[:n]


def test_bytes_bound_a_pull(spark, root, monkeypatch):
    options = fill(spark, root)
    sizes = [i % 7 for i in range(300)]
    for few in (10_000, 10):
        monkeypatch.setattr(O, "FEW", few)
        for most, n in ((1, 300), (50, 300), (50, 5), (10**6, 300), (21, 17)):
            total, want = 0, []
            for i, size in enumerate(sizes[:n]):
                total += size
                if want and total > most:
                    break
                want.append(i)
            assert numbers(read_messages(spark, max_messages=n, max_bytes=most, **options)) == want
    large = {**options, "topic": "large"}
    publish(spark.sql("select repeat('y', 100) as d"), root=root, topic="large", payload="d")
    assert pull_messages(spark, maxInboundMessageSize=10, **large).messages.count() == 1
    assert read_topic(spark, Topic(root, "large")).count() == 1
    with pytest.raises(ValueError, match="positive"):
        pull_messages(spark, max_bytes=0, **options)
