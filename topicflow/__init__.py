"""Message topics on Spark: publish rows, pull envelopes, decode payloads, keep delivery state."""

from topicflow.functions.avro_schema import from_avro_text, to_avro_text
from topicflow.functions.envelope import attributes_text, to_envelope
from topicflow.functions.payload import decode_payload, expand_payload, row_payload, row_text
from topicflow.operators.delivery import Pull, ack_pull, modify_lease, pull_messages, read_messages
from topicflow.operators.publish import publish, to_messages
from topicflow.operators.state import backlog, eligible, has_backlog
from topicflow.options import Subscription, Topic
from topicflow.schema import ENVELOPE_SCHEMA, TOPIC_SCHEMA
from topicflow.sources.topic import read_topic
from topicflow.streaming.control import StaleCheckpointError, await_query
from topicflow.streaming.fence import FencedError
from topicflow.streaming.read import process_stream, read_stream_messages
from topicflow.streaming.write import write_stream_messages

__all__ = [
    "ENVELOPE_SCHEMA",
    "FencedError",
    "TOPIC_SCHEMA",
    "Pull",
    "StaleCheckpointError",
    "Subscription",
    "Topic",
    "ack_pull",
    "attributes_text",
    "await_query",
    "backlog",
    "decode_payload",
    "eligible",
    "expand_payload",
    "from_avro_text",
    "has_backlog",
    "modify_lease",
    "process_stream",
    "publish",
    "pull_messages",
    "read_messages",
    "read_stream_messages",
    "read_topic",
    "row_payload",
    "row_text",
    "to_avro_text",
    "to_envelope",
    "to_messages",
    "write_stream_messages",
]
