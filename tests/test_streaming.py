import os
import shutil
import threading
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from topicflow import (
    StaleCheckpointError,
    Subscription,
    Topic,
    await_query,
    eligible,
    process_stream,
    publish,
    pull_messages,
    read_stream_messages,
    read_topic,
    write_stream_messages,
)
from topicflow.operators.maintenance import compact_acks
from topicflow.operators.state import read_file_acks
from topicflow.sources.files import stream_csv
from topicflow.storage import list_dirs
from topicflow.streaming import slices
from topicflow.streaming.control import with_trigger


@pytest.fixture
def options(root):
    return {"root": root, "topic": "t", "subscription": "s"}


def fill(spark, root, first, last, parts=1):
    df = spark.range(first, last, 1, parts).select(F.col("id").cast("string").alias("m"))
    publish(df, root=root, topic="t", payload="m", message_id="m")


class Keeper:
    """Keeps what each batch delivered, by offset."""

    def __init__(self, fail_at=None):
        self.batches, self.fail_at = {}, fail_at

    def __call__(self, messages, offset):
        if offset == self.fail_at:
            raise RuntimeError("handler failed")
        rows = messages.collect()
        assert {r.offset for r in rows} <= {offset}
        self.batches[offset] = sorted(int(r.message_id) for r in rows)

    @property
    def seen(self):
        return sorted(i for batch in self.batches.values() for i in batch)


def drain(spark, root, options, keeper, **bounds):
    query = process_stream(
        spark, keeper, returnImmediatelyWhilePull="true", checkpointLocation=f"{root}/cp",
        **options, **bounds,
    )
    assert await_query(query, 120, f"{root}/cp")
    return query


def test_every_message_once_over_restarts(spark, root, options):
    fill(spark, root, 0, 10)
    keeper = Keeper()
    drain(spark, root, options, keeper)
    drain(spark, root, options, keeper)
    assert keeper.batches == {1: list(range(10))}
    fill(spark, root, 10, 15)
    drain(spark, root, options, keeper)
    assert keeper.batches[2] == list(range(10, 15))


def test_files_per_trigger_bound_batches_and_offsets_count_them(spark, root, options):
    fill(spark, root, 0, 60, parts=6)
    keeper = Keeper()
    drain(spark, root, options, keeper, max_files=2)
    assert sorted(keeper.batches) == [1, 2, 3]
    assert all(len(b) == 20 for b in keeper.batches.values())
    assert keeper.seen == list(range(60))


def test_bytes_per_trigger(spark, root, options):
    fill(spark, root, 0, 60, parts=6)
    keeper = Keeper()
    drain(spark, root, options, keeper, max_bytes=1)
    assert len(keeper.batches) == 6 and keeper.seen == list(range(60))


def test_only_one_bound(spark, root, options):
    with pytest.raises(ValueError, match="not both"):
        read_stream_messages(spark, max_files=1, max_bytes=1, **options)


def test_empty_topic_runs_no_batch(spark, root, options):
    keeper = Keeper()
    drain(spark, root, options, keeper)
    assert keeper.batches == {}


def test_failed_batch_is_replayed_and_acked_only_after_success(spark, root, options):
    fill(spark, root, 0, 30, parts=3)
    keeper = Keeper(fail_at=2)
    with pytest.raises(Exception, match="handler failed"):
        drain(spark, root, options, keeper, max_files=1)
    sub = Subscription.of(options)
    assert list(keeper.batches) == [1]
    assert read_file_acks(spark, sub).count() == 1
    assert eligible(spark, sub).count() == 20
    keeper.fail_at = None
    drain(spark, root, options, keeper, max_files=1)
    assert sorted(keeper.batches) == [1, 2, 3] and keeper.seen == list(range(30))
    assert eligible(spark, sub).count() == 0


def test_batch_acked_but_not_committed_is_harmless(spark, root, options):
    """The driver dies after the ack and before Spark commits the batch: the replay must not
    hand over an empty batch under the same offset, which would overwrite its output."""
    fill(spark, root, 0, 10)
    keeper = Keeper()
    drain(spark, root, options, keeper)
    shutil.rmtree(f"{root}/cp/commits")
    drain(spark, root, options, keeper)
    assert keeper.batches == {1: list(range(10))}
    assert read_file_acks(spark, Subscription.of(options)).count() == 1
    shutil.rmtree(f"{root}/cp/commits")
    compact_acks(spark, Subscription.of(options))
    drain(spark, root, options, keeper)
    assert keeper.batches == {1: list(range(10))}


def test_batch_handled_but_not_acked_is_replayed(spark, root, options):
    """The driver dies between the handler and the ack."""
    fill(spark, root, 0, 10)
    keeper = Keeper()
    drain(spark, root, options, keeper)
    shutil.rmtree(f"{root}/cp/commits")
    shutil.rmtree(Subscription.of(options).file_acks)
    keeper.batches.clear()
    drain(spark, root, options, keeper)
    assert keeper.batches == {1: list(range(10))}


def test_root_with_a_space(spark, tmp_path):
    root = str(tmp_path / "a b")
    fill(spark, root, 0, 5)
    keeper = Keeper()
    drain(spark, root, {"root": root, "topic": "t", "subscription": "s"}, keeper)
    assert keeper.seen == list(range(5))
    sub = {"root": root, "topic": "t", "subscription": "q"}
    assert pull_messages(spark, **sub).messages.count() == 5


def test_stream_and_pull_share_a_subscription(spark, root, options):
    fill(spark, root, 0, 20)
    pull = pull_messages(spark, max_messages=5, **options)
    pulled = sorted(int(r.message_id) for r in pull.messages.collect())
    pull.ack()
    keeper = Keeper()
    drain(spark, root, options, keeper)
    assert sorted(keeper.seen + pulled) == list(range(20))
    assert pull_messages(spark, **options).messages.isEmpty()


def test_handler_sees_an_ordinary_scan(spark, root, options):
    """Filters and columns of the handler reach the Parquet reader."""
    fill(spark, root, 0, 10)
    plans = []

    def look(messages, offset):
        assert messages.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
        chosen = messages.where("message_id = '3'").select("message_id")
        plans.append(chosen._jdf.queryExecution().executedPlan().toString())

    query = process_stream(
        spark, look, available_now=True, checkpoint=f"{root}/cp", stored=True, **options
    )
    assert await_query(query, 120)
    assert "EqualTo(message_id,3)" in plans[0]
    assert "data:binary" not in plans[0]


def test_cursor_reads_no_column(spark, root, options):
    fill(spark, root, 0, 10)
    keeper = Keeper()
    query = drain(spark, root, options, keeper)
    plan = query._jsq.explainInternal(False)
    assert "ReadSchema: struct<>" in plan


def test_raw_stream_has_fixed_columns(spark, root, options):
    fill(spark, root, 0, 5)
    stream = read_stream_messages(spark, **options)
    assert stream.isStreaming and stream.columns == [
        "subscription", "offset", "data", "publish_timestamp", "event_timestamp", "attributes", "message_id",
    ]
    with pytest.raises(ValueError, match="schema is fixed"):
        read_stream_messages(spark, schema="a int", **options)


def age(root, days):
    """Publishes as if they were written that long ago."""
    then = time.time() - days * 86400
    for path in Path(root).rglob("*.parquet"):
        os.utime(path, (then, then))


@pytest.mark.parametrize("raw", [False, True])
def test_old_files_are_not_dropped(spark, root, options, raw):
    fill(spark, root, 0, 5)
    age(root, 20)
    fill(spark, root, 5, 12)
    keeper = Keeper()
    if raw:
        stream = read_stream_messages(spark, max_files=1, **options)
        writer = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{root}/cp")
        query = writer.foreachBatch(lambda df, i: keeper(df.withColumn("offset", F.lit(i)), i)).start()
        assert await_query(query, 120)
    else:
        drain(spark, root, options, keeper, max_files=1)
    assert keeper.seen == list(range(12))


def test_old_csv_files_are_not_dropped(spark, root, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "old.csv").write_text("1,2\n")
    then = time.time() - 20 * 86400
    os.utime(tmp_path / "in" / "old.csv", (then, then))
    (tmp_path / "in" / "new.csv").write_text("3,4\n")
    publish_stream(spark, root, stream_csv(spark, str(tmp_path / "in"), "a int, b int", max_files=1))
    assert payloads(spark, root) == ["[1,2]", "[3,4]"]


def test_messages_bound_a_trigger(spark, root, options):
    fill(spark, root, 0, 9, parts=3)
    keeper = Keeper()
    drain(spark, root, options, keeper, messageCountPerBatch=1)
    assert len(keeper.batches) == 9 and keeper.seen == list(range(9))


@pytest.mark.parametrize("width", [1, 4, 7, 30, 100])
def test_no_batch_has_more_messages(spark, root, options, width):
    """Slices run over the ends of files and inside them."""
    fill(spark, root, 0, 10, parts=3)
    fill(spark, root, 10, 33, parts=2)
    keeper = Keeper()
    drain(spark, root, options, keeper, max_messages=width)
    assert keeper.seen == list(range(33)) and sorted(keeper.batches) == list(range(1, -(-33 // width) + 1))
    assert all(len(b) == width for o, b in keeper.batches.items() if o < len(keeper.batches))
    fill(spark, root, 33, 40)
    drain(spark, root, options, keeper, max_messages=width)
    assert keeper.seen == list(range(40))
    assert max(keeper.batches) == -(-33 // width) - (-7 // width)
    assert eligible(spark, Subscription.of(options)).isEmpty()


@pytest.mark.parametrize("parts", [1, 6])
def test_a_restart_goes_on_in_the_middle_of_a_file(spark, root, options, parts):
    fill(spark, root, 0, 30, parts=parts)
    keeper, sub = Keeper(fail_at=4), Subscription.of(options)
    with pytest.raises(Exception, match="handler failed"):
        drain(spark, root, options, keeper, max_messages=7)
    assert sorted(keeper.batches) == [1, 2, 3] and keeper.seen == list(range(21))
    # what is done is hidden from pulls, also after upkeep; what is not is seen by them
    assert eligible(spark, sub).count() == 9
    compact_acks(spark, sub)
    pull = pull_messages(spark, max_messages=2, **options)
    assert sorted(int(r.message_id) for r in pull.messages.collect()) == [21, 22]
    pull.ack()
    # another width does not cut the batch anew
    keeper.fail_at = None
    drain(spark, root, options, keeper, max_messages=3)
    assert keeper.batches[4] == [23, 24, 25, 26, 27] and keeper.batches[5] == [28, 29]
    assert eligible(spark, sub).isEmpty()
    fill(spark, root, 30, 36)
    drain(spark, root, options, keeper, max_messages=3)
    assert keeper.batches[6] == [30, 31, 32] and keeper.batches[7] == [33, 34, 35]


def test_slices_done_but_not_committed_are_not_handled_again(spark, root, options):
    fill(spark, root, 0, 10)
    keeper = Keeper()
    drain(spark, root, options, keeper, max_messages=4)
    before = dict(keeper.batches)
    for lost in (f"{root}/cp/commits", Subscription.of(options).file_acks):
        shutil.rmtree(lost)
    drain(spark, root, options, keeper, max_messages=4)
    assert keeper.batches == before == {1: [0, 1, 2, 3], 2: [4, 5, 6, 7], 3: [8, 9]}


def test_a_file_is_read_once_for_many_slices(spark, root, options, monkeypatch):
    fill(spark, root, 0, 40)
    scans = []
    original = slices._scan
    monkeypatch.setattr(slices, "_scan", lambda *a: scans.append(a) or original(*a))
    monkeypatch.setattr(slices, "AT_ONCE", 8)
    keeper = Keeper()
    drain(spark, root, options, keeper, max_messages=2)
    assert keeper.seen == list(range(40)) and len(keeper.batches) == 20 and len(scans) == 3
    assert list_dirs(spark, Subscription.of(options).staging) == []


class Counter:
    """What each call delivered, by its first batch: the messages of every batch."""

    def __init__(self, fail_at=None):
        self.calls, self.fail_at = {}, fail_at

    def __call__(self, messages, offset):
        if offset == self.fail_at:
            raise RuntimeError("handler failed")
        batches = self.calls.setdefault(offset, {})
        for r in messages.collect():
            batches.setdefault(r.offset, []).append(int(r.message_id))

    @property
    def sizes(self):
        return {offset: {b: len(ids) for b, ids in sorted(call.items())} for offset, call in self.calls.items()}

    @property
    def seen(self):
        return sorted(i for call in self.calls.values() for ids in call.values() for i in ids)


@pytest.mark.parametrize("parts", [1, 30])
def test_several_batches_are_handled_at_once(spark, root, options, monkeypatch, parts):
    """Also over passes of two groups, and where files are small enough to be read directly."""
    monkeypatch.setattr(slices, "AT_ONCE", 2)
    fill(spark, root, 0, 40, parts=parts)
    counter = Counter()
    drain(spark, root, options, counter, max_messages=3, batches_at_once=4)
    sizes = {1: 3, 2: 3, 3: 3, 4: 3}
    later = [{b + 4 * i: 3 for b in sizes} for i in range(3)]
    assert counter.sizes == {1: later[0], 5: later[1], 9: later[2], 13: {13: 3, 14: 1}}
    assert counter.seen == list(range(40))
    assert eligible(spark, Subscription.of(options)).isEmpty()
    assert list_dirs(spark, Subscription.of(options).staging) == []


def test_batches_given_together_come_together_again(spark, root, options):
    """A handler may have written all of them before it failed."""
    fill(spark, root, 0, 40)
    counter, sub = Counter(fail_at=4), Subscription.of(options)
    with pytest.raises(Exception, match="handler failed"):
        drain(spark, root, options, counter, max_messages=2, batches_at_once=3)
    assert eligible(spark, sub).count() == 34
    counter.fail_at = 7
    with pytest.raises(Exception, match="handler failed"):
        drain(spark, root, options, counter, max_messages=2, batches_at_once=10)
    assert [sorted(c) for c in counter.sizes.values()] == [[1, 2, 3], [4, 5, 6]]
    counter.fail_at = None
    drain(spark, root, options, counter, max_messages=2)
    assert sorted(counter.sizes[7]) == list(range(7, 17)) and sorted(counter.sizes) == [1, 4, 7, 17, 18, 19, 20]
    assert counter.seen == list(range(40)) and eligible(spark, sub).isEmpty()


def test_batches_at_once_need_a_bound_in_messages(spark, root, options):
    with pytest.raises(ValueError, match="max_messages"):
        drain(spark, root, options, Counter(), batches_at_once=2)


def test_the_stream_that_started_last_acknowledges(spark, root, options):
    fill(spark, root, 0, 10)
    sub, entered, released, late = Subscription.of(options), threading.Event(), threading.Event(), Keeper()

    def slow(messages, offset):
        entered.set()
        released.wait(60)

    early = process_stream(spark, slow, available_now=True, checkpoint=f"{root}/early", **options)
    assert entered.wait(60)
    drain(spark, root, options, late)
    acks = read_file_acks(spark, sub).select("ack_id").collect()
    released.set()
    with pytest.raises(Exception, match="FencedError"):
        await_query(early, 60)
    assert late.seen == list(range(10)) and read_file_acks(spark, sub).select("ack_id").collect() == acks
    assert len(list_dirs(spark, sub.epochs)) == 1


def test_console(spark, root, options):
    fill(spark, root, 0, 3)
    writer = read_stream_messages(spark, **options).writeStream.format("console")
    query = writer.trigger(availableNow=True).option("checkpointLocation", f"{root}/cp").start()
    assert await_query(query, 120)
    assert sum(p["numInputRows"] for p in query.recentProgress) == 3


def test_upkeep_while_a_stream_runs(spark, root, options):
    """Compaction after every batch: nothing is lost or repeated."""
    fill(spark, root, 0, 12, parts=4)
    sub, keeper = Subscription.of(options), Keeper()

    def handle(messages, offset):
        keeper(messages, offset)
        compact_acks(spark, sub, keep_seconds=0)

    drain(spark, root, options, handle, max_files=1)
    fill(spark, root, 12, 20, parts=2)
    drain(spark, root, options, handle, max_files=1)
    assert keeper.seen == list(range(20))
    assert eligible(spark, sub).isEmpty()


def csv_stream(spark, path, rows):
    Path(path).mkdir(parents=True, exist_ok=True)
    for name, text in rows.items():
        Path(path, name).write_text(text)
    return spark.readStream.schema("a int, b int").option("maxFilesPerTrigger", 1).csv(path)


def payloads(spark, root, topic="out"):
    rows = read_topic(spark, Topic(root, topic)).collect()
    return sorted(bytes(r.data).decode() for r in rows)


def publish_stream(spark, root, source, **more):
    query = write_stream_messages(
        source, root=root, topic="out", checkpoint=f"{root}/out-cp", available_now=True, **more
    )
    assert await_query(query, 120)
    return query


def uncommit(checkpoint):
    """As if the driver had died before Spark committed the last batch."""
    last = max(Path(checkpoint, "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    last.with_name(f".{last.name}.crc").unlink()


def test_stream_publish_and_replay(spark, root, tmp_path):
    source = csv_stream(spark, str(tmp_path / "in"), {"1.csv": "1,2\n3,4\n", "2.csv": "5,\n"})
    query = publish_stream(spark, root, source)
    names = {r.publish_id for r in read_topic(spark, Topic(root, "out")).collect()}
    assert names == {f"{query.id}-0", f"{query.id}-1"}
    assert payloads(spark, root) == ["[1,2]", "[3,4]", "[5,null]"]
    # the driver dies between the publish and the commit of the last batch
    uncommit(f"{root}/out-cp")
    publish_stream(spark, root, source)
    assert payloads(spark, root) == ["[1,2]", "[3,4]", "[5,null]"]


def test_new_checkpoint_is_not_taken_for_a_replay(spark, root, tmp_path):
    source = csv_stream(spark, str(tmp_path / "in"), {"1.csv": "1,2\n"})
    publish_stream(spark, root, source)
    query = write_stream_messages(
        source, root=root, topic="out", checkpoint=f"{root}/other", available_now=True
    )
    assert await_query(query, 120)
    assert payloads(spark, root) == ["[1,2]", "[1,2]"]


def test_stream_publish_with_content_ids(spark, root, tmp_path):
    source = csv_stream(spark, str(tmp_path / "in"), {"1.csv": "1,2\n1,2\n1,2\n"})
    publish_stream(spark, root, source, ids="content")
    assert payloads(spark, root) == ["[1,2]"] * 3
    assert read_topic(spark, Topic(root, "out")).select("message_id").distinct().count() == 3


def test_checkpoint_of_another_query(spark, root, tmp_path):
    source = csv_stream(spark, str(tmp_path / "in"), {"1.csv": "1,2\n"})
    publish_stream(spark, root, source)
    other = csv_stream(spark, str(tmp_path / "more"), {"1.csv": "3,4\n"})
    query = write_stream_messages(
        source.union(other), root=root, topic="out", checkpoint=f"{root}/out-cp", available_now=True
    )
    with pytest.raises(StaleCheckpointError, match="new checkpoint path"):
        await_query(query, 120, f"{root}/out-cp")


def test_other_stream_errors_stay_as_they_are(spark, root, options):
    fill(spark, root, 0, 1)
    with pytest.raises(Exception, match="handler failed") as caught:
        drain(spark, root, options, Keeper(fail_at=1))
    assert not isinstance(caught.value, StaleCheckpointError)


def test_triggers(spark):
    writer = spark.readStream.format("rate").load().writeStream
    with pytest.raises(ValueError, match="not both"):
        with_trigger(writer, {"checkpoint": "/tmp/c", "available_now": True, "interval": "5 seconds"})
    with pytest.raises(ValueError, match="checkpoint is required"):
        with_trigger(writer, {})


def test_fixed_interval_runs_until_stopped(spark, root, options):
    fill(spark, root, 0, 5)
    keeper = Keeper()
    query = process_stream(
        spark, keeper, interval="1 second", checkpoint=f"{root}/cp", **options
    )
    try:
        query.processAllAvailable()
        assert not await_query(query, 1)
        fill(spark, root, 5, 8)
        query.processAllAvailable()
    finally:
        query.stop()
    assert keeper.seen == list(range(8))
