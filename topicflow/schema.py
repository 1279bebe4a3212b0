"""Fixed schemas: the message envelope, the topic table and the delivery tables."""

from __future__ import annotations

from pyspark.sql import types as T

#: What every read returns, in this order.
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("subscription", T.StringType(), True),
        T.StructField("offset", T.LongType(), False),
        T.StructField("data", T.BinaryType(), True),
        T.StructField("publish_timestamp", T.LongType(), False),
        T.StructField("event_timestamp", T.LongType(), False),
        T.StructField("attributes", T.StringType(), True),
        T.StructField("message_id", T.StringType(), True),
    ]
)

#: One stored message. ``publish_id`` is the directory the message was published under.
TOPIC_SCHEMA = T.StructType(
    [
        T.StructField("message_id", T.StringType(), True),
        T.StructField("data", T.BinaryType(), True),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType()), True),
        T.StructField("publish_time", T.TimestampType(), True),
        T.StructField("publish_id", T.StringType(), True),
    ]
)

#: One row for each stored file: how many messages it holds and between which publish times
#: (epoch microseconds). Written with the publish and visible with it.
FILE_SCHEMA = T.StructType(
    [
        T.StructField("publish_id", T.StringType(), True),
        T.StructField("file_name", T.StringType(), True),
        T.StructField("messages", T.LongType(), True),
        T.StructField("first_micros", T.LongType(), True),
        T.StructField("last_micros", T.LongType(), True),
    ]
)

#: Acknowledged messages as ranges of rows of a file, ``from_row`` to before ``to_row``: a directory for
#: each acknowledgement (``ack_id``), in it one for each publish, so that the acks of some publishes are
#: found without opening the others.
ACK_SCHEMA = T.StructType(
    [
        T.StructField("subscription", T.StringType(), True),
        T.StructField("file_name", T.StringType(), True),
        T.StructField("from_row", T.LongType(), True),
        T.StructField("to_row", T.LongType(), True),
        T.StructField("acked_at", T.LongType(), True),
        T.StructField("ack_id", T.StringType(), True),
        T.StructField("publish_id", T.StringType(), True),
    ]
)

#: Files whose every message is acknowledged: what a stream batch writes, one row per file.
FILE_ACK_SCHEMA = T.StructType(
    [
        T.StructField("subscription", T.StringType(), True),
        T.StructField("file_name", T.StringType(), True),
        T.StructField("acked_at", T.LongType(), True),
        T.StructField("ack_id", T.StringType(), True),
        T.StructField("publish_id", T.StringType(), True),
    ]
)

#: Pulled messages hidden until ``lease_until`` (epoch ms). Each lease is a numbered claim on the
#: subscription. The partition columns come last; an expired lease is passed over as a directory, without
#: opening a file.
LEASE_SCHEMA = T.StructType(
    [
        T.StructField("subscription", T.StringType(), True),
        T.StructField("publish_id", T.StringType(), True),
        T.StructField("file_name", T.StringType(), True),
        T.StructField("position", T.LongType(), True),
        T.StructField("message_id", T.StringType(), True),
        T.StructField("claim", T.LongType(), True),
        T.StructField("lease_until", T.LongType(), True),
        T.StructField("pull_id", T.StringType(), True),
    ]
)

#: New deadlines of messages of a pull, numbered by ``sequence``; a message has its latest one.
DEADLINE_SCHEMA = T.StructType(
    [
        T.StructField("publish_id", T.StringType(), True),
        T.StructField("file_name", T.StringType(), True),
        T.StructField("position", T.LongType(), True),
        T.StructField("pull_id", T.StringType(), True),
        T.StructField("sequence", T.LongType(), True),
        T.StructField("lease_until", T.LongType(), True),
    ]
)

#: The files of a stream batch that is cut into slices; ``base`` rows of the batch stand before a file.
SLICE_SCHEMA = T.StructType(
    [
        T.StructField("publish_id", T.StringType(), True),
        T.StructField("file_name", T.StringType(), True),
        T.StructField("base", T.LongType(), True),
        T.StructField("messages", T.LongType(), True),
    ]
)

#: Publishes a subscription has finished with.
RETIRED_SCHEMA = T.StructType([T.StructField("publish_id", T.StringType(), True)])

#: A stored file is identified by where it was published and its name.
FILE_KEY = ["publish_id", "file_name"]

#: A message is identified by where it stands: its file and its row there. Stored files never
#: change, so that is unique and stable whatever ids the publisher gives, repeated or null ones too.
KEY = [*FILE_KEY, "position"]

#: Rows of a file, ``from_row`` to before ``to_row``.
ROWS = [*FILE_KEY, "from_row", "to_row"]
