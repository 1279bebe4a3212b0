from datetime import datetime, timedelta, timezone

import pytest

from topicflow import Subscription, publish, read_messages, read_stream_messages, write_stream_messages
from topicflow.options import check_output_mode, checked, normalize, to_millis


def test_known_spellings():
    assert normalize({"projectId": "r", "subscriptionId": "s", "messageCountPerBatch": "5"}) == {
        "root": "r",
        "subscription": "s",
        "max_messages": "5",
    }


def test_request_size_is_accepted_and_changes_nothing():
    assert checked({"writeBatchSize": 100, "root": "r"}, "root") == {"root": "r"}


def test_twice_and_unknown():
    with pytest.raises(ValueError, match="twice"):
        normalize({"topic": "a", "topicId": "b"})
    with pytest.raises(ValueError, match="Unknown option colour"):
        checked({"colour": 1, "root": "r"}, "root")


@pytest.mark.parametrize("missing", ["root", "topic", "subscription"])
def test_required_for_reading(spark, missing):
    options = {"root": "/tmp/none", "topic": "t", "subscription": "s"}
    del options[missing]
    with pytest.raises(ValueError, match=f"{missing} is required"):
        read_messages(spark, **options)
    with pytest.raises(ValueError, match=f"{missing} is required"):
        read_stream_messages(spark, **options)


def test_required_for_writing(spark, root):
    stream = spark.readStream.format("rate").load()
    with pytest.raises(ValueError, match="checkpoint is required"):
        write_stream_messages(stream, root=root, topic="t")
    with pytest.raises(ValueError, match="topic is required"):
        write_stream_messages(stream, root=root, checkpoint=f"{root}/c")


def test_overwrite_is_refused_other_modes_publish(spark, root):
    from topicflow import Topic, read_topic

    df = spark.range(3)
    with pytest.raises(ValueError, match="append-only"):
        publish(df, root=root, topic="t", mode="Overwrite")
    with pytest.raises(ValueError, match="Unknown save mode"):
        publish(df, root=root, topic="t", mode="upsert")
    for mode in ("append", "ErrorIfExists", "ignore"):
        publish(df, root=root, topic="t", mode=mode)
    assert read_topic(spark, Topic(root, "t")).count() == 9


def test_output_mode(spark, root):
    check_output_mode("Append")
    stream = spark.readStream.format("rate").load()
    with pytest.raises(ValueError, match="only appended"):
        write_stream_messages(
            stream, root=root, topic="t", checkpoint=f"{root}/c", output_mode="complete"
        )


def test_names_are_safe_as_directories():
    for bad in ("", "a/b", "..", "_x", "a b", "x=y"):
        with pytest.raises(ValueError):
            Subscription.of({"root": "/r", "topic": "t", "subscription": bad})


def test_state_path_default_and_option():
    options = {"root": "/r/", "topic": "t", "subscription": "s"}
    assert Subscription.of(options).state_path == "/r/subscriptions/t/s"
    assert Subscription.of({**options, "state_path": "/x/"}).state_path == "/x"


def test_instants():
    naive = datetime(1970, 1, 1, 0, 0, 1)
    assert to_millis(naive) == 1000
    assert to_millis(naive.replace(tzinfo=timezone(timedelta(hours=1)))) == 1000 - 3_600_000
    assert to_millis(datetime(1969, 12, 31, 23, 59, 59, 999_999)) == -1
    assert to_millis(7) == 7
