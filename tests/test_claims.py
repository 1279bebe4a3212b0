"""Pulls that happen at once, deadlines that change, pulls that wait."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from topicflow import Subscription, eligible, modify_lease, publish, pull_messages
from topicflow.operators import delivery
from topicflow.operators.delivery import lease, wait_for_messages
from topicflow.operators.maintenance import drop_expired_leases
from topicflow.operators.state import read_leases
from topicflow.storage import find, list_dirs

NOW = 1_000_000


@pytest.fixture
def options(spark, root):
    fill(spark, root, 0, 30, "a")
    return {"root": root, "topic": "t", "subscription": "s"}


def fill(spark, root, first, last, publish_id):
    df = spark.range(first, last, 1, 2).select(F.col("id").cast("string").alias("m"), F.timestamp_millis("id").alias("t"))
    publish(df, root=root, topic="t", publish_id=publish_id, payload="m", message_id="m", publish_time="t")


def numbers(df):
    return sorted(int(r.message_id) for r in df.select("message_id").collect())


def test_a_puller_that_comes_second_chooses_again(spark, options, monkeypatch):
    """A second pull commits between the choice and the claim of the first."""
    original, others = delivery._claim, []

    def interrupted(*args):
        if not others:
            others.append(None)
            others[0] = pull_messages(spark, max_messages=10, as_of=NOW, **options)
        return original(*args)

    monkeypatch.setattr(delivery, "_claim", interrupted)
    first = pull_messages(spark, max_messages=10, as_of=NOW, **options)
    assert numbers(others[0].messages) == list(range(10))
    assert numbers(first.messages) == list(range(10, 20))
    assert list_dirs(spark, Subscription.of(options).leases) == ["claim=1", "claim=2"]
    assert list_dirs(spark, Subscription.of(options).staging) == []


def test_many_pullers_at_once_share_the_messages(spark, options):
    pulls = []
    work = [threading.Thread(target=lambda: pulls.append(pull_messages(spark, max_messages=7, as_of=NOW, **options))) for _ in range(4)]
    for w in work:
        w.start()
    for w in work:
        w.join()
    assert sorted(i for p in pulls for i in numbers(p.messages)) == list(range(28))


def test_one_pull_id_at_once_is_one_pull(spark, options, monkeypatch):
    original, others = delivery._claim, []

    def interrupted(*args):
        if not others:
            others.append(None)
            others[0] = pull_messages(spark, pull_id="p", max_messages=3, as_of=NOW, **options)
        return original(*args)

    monkeypatch.setattr(delivery, "_claim", interrupted)
    again = pull_messages(spark, pull_id="p", max_messages=3, as_of=NOW, **options)
    assert not again.new and numbers(again.messages) == numbers(others[0].messages) == [0, 1, 2]


def test_a_lease_keeps_its_number_free_of_others(spark, options):
    sub = Subscription.of(options)
    pull = pull_messages(spark, max_messages=3, as_of=NOW, **options)
    lease(spark, sub, pull.leased, pull_id="more", as_of=NOW)
    held = lease(spark, sub, pull.leased, pull_id="more", as_of=NOW + 5)
    assert [p.removeprefix("file:") for p in find(spark, f"{sub.leases}/claim=2/*/*")] == [held.removeprefix("file:")]


def test_deadlines_change_message_by_message(spark, options):
    sub = Subscription.of(options)
    pull = pull_messages(spark, max_messages=6, as_of=NOW, lease_seconds=100, **options)
    pull.modify_lease(0, where="message_id in ('0', '1')", as_of=NOW + 1000)
    pull.modify_lease(500, where=F.col("message_id") == "5", as_of=NOW + 1000)
    assert numbers(eligible(spark, sub, NOW + 2000)) == [0, 1, *range(6, 30)]
    assert numbers(eligible(spark, sub, NOW + 101_000)) == [0, 1, 2, 3, 4, *range(6, 30)]
    assert numbers(eligible(spark, sub, NOW + 502_000)) == list(range(30))
    # the latest change counts, whichever is longer
    pull.modify_lease(900, where="message_id = '0'", as_of=NOW + 1500)
    pull.modify_lease(1, where="message_id = '5'", as_of=NOW + 1500)
    assert numbers(eligible(spark, sub, NOW + 3000)) == [1, 5, *range(6, 30)]
    assert numbers(read_leases(spark, sub, NOW + 200_000)) == [0]
    pull.ack()
    assert numbers(eligible(spark, sub, NOW + 10**9)) == list(range(6, 30))


def test_a_message_given_back_is_pulled_by_another(spark, options):
    sub = Subscription.of(options)
    first = pull_messages(spark, max_messages=5, as_of=NOW, **options)
    modify_lease(spark, sub, first.pull_id, 0, as_of=NOW)
    second = pull_messages(spark, max_messages=5, as_of=NOW + 1, **options)
    assert numbers(second.messages) == numbers(first.messages) == list(range(5))
    assert numbers(eligible(spark, sub, NOW + 2)) == list(range(5, 30))
    with pytest.raises(ValueError, match="No pull"):
        modify_lease(spark, sub, "none", 5)
    with pytest.raises(ValueError, match="-1 seconds"):
        first.modify_lease(-1)


def test_upkeep_keeps_leases_that_were_extended_and_the_last_number(spark, options):
    sub = Subscription.of(options)
    kept = pull_messages(spark, pull_id="kept", max_messages=2, as_of=NOW, lease_seconds=1, **options)
    kept.modify_lease(10_000, as_of=NOW)
    pull_messages(spark, pull_id="gone", max_messages=2, as_of=NOW, lease_seconds=1, **options)
    assert drop_expired_leases(spark, sub, keep_seconds=1, as_of=NOW + 9000) == [f"lease_until={NOW + 1000}"]
    assert list_dirs(spark, sub.leases) == ["claim=1", "claim=2"]
    assert numbers(eligible(spark, sub, NOW + 9000)) == list(range(2, 30))
    pull_messages(spark, pull_id="next", max_messages=2, as_of=NOW + 9000, **options)
    assert list_dirs(spark, sub.leases) == ["claim=1", "claim=2", "claim=3"]
    drop_expired_leases(spark, sub, keep_seconds=1, as_of=NOW + 10**9)
    assert list_dirs(spark, sub.leases) == ["claim=3"] and list_dirs(spark, sub.deadlines) == []


def test_a_pull_waits_for_a_publish(spark, root):
    options = {"root": root, "topic": "t", "subscription": "s"}
    later = threading.Timer(1.5, lambda: fill(spark, root, 0, 5, "late"))
    later.start()
    assert numbers(pull_messages(spark, wait_seconds=60, as_of=NOW, **options).messages) == list(range(5))
    later.join()


def test_a_pull_waits_for_a_lease_to_end(spark, options):
    pull_messages(spark, max_messages=30, lease_seconds=4, **options)
    assert pull_messages(spark, max_messages=30, **options).messages.isEmpty()
    assert numbers(pull_messages(spark, max_messages=30, wait_seconds=60, **options).messages) == list(range(30))


def test_waiting_ends_with_the_empty_envelope(spark, root):
    options = {"root": root, "topic": "t", "subscription": "s"}
    begin = time.monotonic()
    pull = pull_messages(spark, wait_seconds=0.5, **options)
    assert 0.5 <= time.monotonic() - begin < 20 and pull.messages.isEmpty()
    assert pull.messages.columns[0] == "subscription"
    assert not wait_for_messages(spark, Subscription.of(options), 0)
