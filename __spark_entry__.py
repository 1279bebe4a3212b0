"""

Every query publishes whole tables of ``sf_dir`` to topics in the shared scratch folder of the
session, runs one operator over them and returns what can be compared with plain SQL over
the same tables. Delivery state is new for each call.
"""

from __future__ import annotations

import hashlib
import sys
import threading
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from topicflow import (  # noqa: E402
    Subscription,
    Topic,
    await_query,
    attributes_text,
    backlog,
    decode_payload,
    eligible,
    expand_payload,
    process_stream,
    publish,
    pull_messages,
    read_messages,
    read_topic,
    row_text,
    to_envelope,
    write_stream_messages,
)
from topicflow.operators.delivery import ack_keys, lease  # noqa: E402
from topicflow.plans.jobs import (  # noqa: E402
    csv_to_topic as run_csv_to_topic,
    decode_republish as run_decode_republish,
    topic_to_csv as run_topic_to_csv,
    topic_to_topic as run_topic_to_topic,
)
from topicflow.operators.maintenance import compact_acks  # noqa: E402
from topicflow.operators.state import read_acks, read_file_acks  # noqa: E402
from topicflow.schema import ENVELOPE_SCHEMA, FILE_KEY, KEY  # noqa: E402
from topicflow.storage import modified_at, shared_scratch  # noqa: E402

#: The instant of every pull below, epoch ms.
AS_OF = 1_700_000_000_000
EVENT_FIELDS = "event_id bigint, user_id bigint, event_type string, value double"
EVENT_AVRO = """{"type": "record", "name": "event", "fields": [
    {"name": "event_id", "type": "long"}, {"name": "user_id", "type": ["null", "int", "long"]},
    {"name": "event_type", "type": {"type": "enum", "name": "kind", "symbols": ["click", "view"]}},
    {"name": "value", "type": ["null", "double"]}]}"""
#: Bytes of a pull, and messages of a stream batch, where a query bounds them.
PULL_BYTES, BATCH_ROWS = 20_000, 1500
#: Batches of so few messages that a handler gets at a time.
BATCHES_AT_ONCE = 1000
#: Seconds a bounded stream may take before the query fails.
STREAM_TIMEOUT = 6000

#: Queries that prepare training data; absent where their package, or what it needs, is.
try:
    from topicflow.llm import queries as _llm
except ImportError:
    _llm = None

_roots: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _root(spark: SparkSession, sf_dir: str, table: str) -> str:
    """One root per session and version of a table, so that its topic is published once."""
    version = f"{sf_dir}|{table}|{modified_at(spark, f'{sf_dir}/{table}.parquet')}"
    key = spark.sparkContext.applicationId + hashlib.sha256(version.encode()).hexdigest()
    if key not in _roots:
        _roots[key] = shared_scratch(spark)
    return _roots[key]


def _text(column: str = "data") -> Column:
    return F.col(column).cast("string")


def _event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON payload with their properties as attributes."""
    return _table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.to_json(F.struct("event_id", "user_id", "event_type", "value")).alias("body"),
        F.from_json("props", "map<string,string>").alias("attrs"),
        "ts",
        "event_type",
    )


_EVENT_MESSAGE = {
    "payload": "body",
    "attributes": "attrs",
    "publish_time": "ts",
    "message_id": "id",
}


def _events(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The topic of all events, and a subscription nobody has used."""
    root = _root(spark, sf_dir, "events")
    rows = _event_rows(spark, sf_dir)
    publish(rows, root=root, topic="ev", publish_id="all", **_EVENT_MESSAGE)
    return _fresh(root, "ev")


def _events_by_type(
    spark: SparkSession, sf_dir: str, *types: str, others: bool = False, topic: str | None = None
) -> dict[str, str]:
    """A new topic with a publish per named event type, and one for all other types."""
    root = _root(spark, sf_dir, "events")
    rows = _event_rows(spark, sf_dir)
    topic = topic or f"ev-{uuid.uuid4().hex}"
    for name in types:
        chosen = rows.where(F.col("event_type") == name)
        publish(chosen, root=root, topic=topic, publish_id=name, **_EVENT_MESSAGE)
    if others:
        rest = rows.where(~F.col("event_type").isin(*types))
        publish(rest, root=root, topic=topic, publish_id="others", **_EVENT_MESSAGE)
    return _fresh(root, topic)


def _fresh(root: str, topic: str) -> dict[str, str]:
    name = f"sub-{uuid.uuid4().hex}"
    state = f"{root}/subscriptions/{name}"
    return {"root": root, "topic": topic, "subscription": "sub", "state_path": state}


def _orders_topic(spark: SparkSession, sf_dir: str) -> Topic:
    root = _root(spark, sf_dir, "orders")
    publish(
        _table(spark, sf_dir, "orders"),
        root=root,
        topic="ord",
        publish_id="all",
        payload=["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"],
        message_id="o_orderkey",
    )
    return Topic(root, "ord")


def _keys_of_type(
    spark: SparkSession, sf_dir: str, sub: Subscription, event_type: str
) -> DataFrame:
    """Keys of the messages whose event has the given type."""
    events = _table(spark, sf_dir, "events").where(F.col("event_type") == event_type)
    ids = events.select(F.col("event_id").cast("string").alias("message_id"))
    stored = read_topic(spark, sub.topic, positions=True).select(*KEY, "message_id")
    return stored.join(ids, "message_id", "left_semi")


def _ack_type(spark: SparkSession, sf_dir: str, sub: Subscription, event_type: str) -> None:
    keys = _keys_of_type(spark, sf_dir, sub, event_type)
    ack_keys(keys, sub, ack_id=f"type-{event_type}", acked_at=AS_OF)


def _lease_type(
    spark: SparkSession, sf_dir: str, sub: Subscription, event_type: str, as_of: int
) -> None:
    keys = _keys_of_type(spark, sf_dir, sub, event_type)
    lease(spark, sub, keys, pull_id=f"type-{event_type}", as_of=as_of)


def _event_id(column: str = "message_id") -> Column:
    return F.col(column).cast("bigint").alias("event_id")


def _envelope_view(envelopes: DataFrame) -> DataFrame:
    """An envelope with its payload as text, so that both engines hash the same values."""
    return envelopes.withColumn("data", _text())


# --- publish -------------------------------------------------------------------------------


def payload_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]
    return orders.select("o_orderkey", row_text(orders, columns).alias("payload"))


def payload_text_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested and typed values: struct, array, map, decimals, both timestamps, null."""
    rows = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.struct("l_partkey", "l_suppkey").alias("keys"),
        F.array(F.col("l_linenumber"), F.lit(None)).alias("numbers"),
        F.create_map("l_returnflag", F.col("l_quantity").cast("int")).alias("quantities"),
        F.col("l_discount").cast("decimal(6,2)").alias("discount"),
        (F.col("l_quantity") / 100_000_000).cast("decimal(18,8)").alias("fraction"),
        F.col("l_shipdate").alias("local_time"),
        F.to_utc_timestamp(F.col("l_shipdate").cast("timestamp"), "UTC").alias("instant"),
        F.lit(None).cast("string").alias("nothing"),
    )
    return rows.select("l_orderkey", "l_linenumber", row_text(rows).alias("payload"))


def payload_text_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals of both kinds, positive, negative and none, as ISO-8601 text."""
    rows = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.expr("make_ym_interval(0, (l_linenumber - 4) * cast(l_quantity as int))").alias("period"),
        F.expr(
            "make_dt_interval(0, 0, 0, cast((l_partkey % 7 - 3) * l_quantity * l_suppkey * 0.025 as decimal(18, 6)))"
        ).alias("duration"),
    )
    return rows.select("l_orderkey", "l_linenumber", row_text(rows, ["period", "duration"]).alias("payload"))


def batch_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = _orders_topic(spark, sf_dir)
    return read_topic(spark, topic).select("message_id", _text().alias("payload"))


def batch_publish_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many equal rows under generated ids: every row is a message, every id is its own."""
    root = _root(spark, sf_dir, "lineitem")
    rows = _table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    publish(rows, root=root, topic="flags", publish_id="all")
    return _copies(read_topic(spark, Topic(root, "flags")))


def batch_publish_content_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows, ids from content: equal rows get ids that differ by copy number only."""
    root = _root(spark, sf_dir, "lineitem")
    rows = _table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    publish(rows, root=root, topic="flags-content", publish_id="all", ids="content")
    return _copies(read_topic(spark, Topic(root, "flags-content")))


def _copies(messages: DataFrame) -> DataFrame:
    by_id = messages.groupBy("data", "message_id").agg(F.count(F.lit(1)).alias("n"))
    return by_id.groupBy(_text().alias("payload")).agg(
        F.sum("n").alias("messages"), F.count(F.lit(1)).alias("ids")
    )


# --- envelope ------------------------------------------------------------------------------


def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    sub = Subscription.of(_events(spark, sf_dir))
    messages = read_topic(spark, sub.topic)
    return _envelope_view(to_envelope(messages, sub.name, as_of=AS_OF))


def envelope_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position, name and type of the envelope columns, with the values each holds."""
    sub = Subscription.of(_events(spark, sf_dir))
    messages = to_envelope(read_topic(spark, sub.topic), sub.name, as_of=AS_OF)
    names = ENVELOPE_SCHEMA.names
    counted = messages.agg(*[F.count(n).alias(n) for n in names])
    types = dict(messages.dtypes)
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(n).alias("name"),
            F.lit(types[n]).alias("type"),
            F.col(n).alias("messages"),
        )
        for i, n in enumerate(names, 1)
    ]
    return counted.select(F.inline(F.array(*rows)))


def attributes_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = read_topic(spark, Subscription.of(_events(spark, sf_dir)).topic)
    return messages.select("message_id", attributes_text(F.col("attributes")).alias("attributes"))


def decode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = read_topic(spark, Subscription.of(_events(spark, sf_dir)).topic)
    return expand_payload(decode_payload(messages, EVENT_FIELDS))


def decode_avro_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON payloads under a schema that is declared as Avro text."""
    messages = read_topic(spark, Subscription.of(_events(spark, sf_dir)).topic)
    return expand_payload(decode_payload(messages, EVENT_AVRO))


def decode_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _root(spark, sf_dir, "orders")
    orders = _table(spark, sf_dir, "orders")
    body = F.to_csv(F.struct("o_orderkey", "o_custkey", "o_orderpriority")).alias("body")
    publish(orders.select(body), root=root, topic="ord-csv", publish_id="all", payload="body")
    messages = read_topic(spark, Topic(root, "ord-csv"))
    fields = "o_orderkey bigint, o_custkey bigint, o_orderpriority string"
    return expand_payload(decode_payload(messages, fields, "csv"))


# --- batch delivery ------------------------------------------------------------------------


def batch_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _envelope_view(read_messages(spark, as_of=AS_OF, **_events(spark, sf_dir)))


def batch_pull_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A large bound: chosen by range, not gathered in one task."""
    options = _events(spark, sf_dir)
    pull = pull_messages(spark, as_of=AS_OF, max_messages=5000, **options)
    return _envelope_view(pull.messages)


def read_and_ack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two reads that acknowledge what they return: the second gets the next messages."""
    options = {**_events(spark, sf_dir), "max_messages": 100}
    read_messages(spark, ack="on_read", as_of=AS_OF, **options)
    return _envelope_view(read_messages(spark, ack="on_read", as_of=AS_OF, **options))


def _repeated_ids(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """A topic of all line items whose ids are three letters, some of them null."""
    root = _root(spark, sf_dir, "lineitem")
    rows = _table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("id"),
        F.col("l_linenumber").cast("string").alias("body"),
        "l_shipdate",
    )
    publish(
        rows, root=root, topic="repeated", publish_id="all",
        payload="body", message_id="id", publish_time="l_shipdate",
    )
    return _fresh(root, "repeated")


def pull_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many messages as asked for, the oldest, although ids repeat or are null."""
    pull = pull_messages(spark, as_of=AS_OF, max_messages=5000, **_repeated_ids(spark, sf_dir))
    return pull.messages.groupBy("publish_timestamp").agg(F.count(F.lit(1)).alias("messages"))


def ack_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First line items acknowledged one by one; each of the others still waits."""
    sub = Subscription.of(_repeated_ids(spark, sf_dir))
    stored = read_topic(spark, sub.topic, positions=True).where(_text() == "1")
    ack_keys(stored.select(*KEY), sub, ack_id="first", acked_at=AS_OF)
    waiting = eligible(spark, sub, AS_OF).groupBy("message_id", _text().alias("line"))
    return waiting.agg(F.count(F.lit(1)).alias("messages"))


def topic_to_topic_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages forwarded by one large pull, then again after upkeep: each once."""
    options = {**_repeated_ids(spark, sf_dir), "max_messages": 100_000_000}
    target, sub = f"forwarded-{uuid.uuid4().hex}", Subscription.of(options)
    for _ in range(2):
        run_topic_to_topic(spark, to_topic=target, pull_id="day-1", as_of=AS_OF, **options)
        compact_acks(spark, sub)
    left = backlog(spark, sub, AS_OF + 10**9).select(F.col("messages").alias("left"))
    copies = read_topic(spark, Topic(sub.topic.root, target)).groupBy("message_id")
    return copies.agg(F.count(F.lit(1)).alias("messages")).crossJoin(left)


def two_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal publish ids and subscription names: acks of one topic do not touch the other."""
    root = _root(spark, sf_dir, "orders")
    run = uuid.uuid4().hex
    orders = _table(spark, sf_dir, "orders").select("o_orderkey")
    subs = {}
    for topic in (f"one-{run}", f"two-{run}"):
        publish(orders, root=root, topic=topic, publish_id="day", message_id="o_orderkey")
        subs[topic[:3]] = Subscription.of({"root": root, "topic": topic, "subscription": f"s-{run}"})
    one, two = subs["one"], subs["two"]
    ack_keys(read_topic(spark, one.topic, positions=True).select(*KEY), one, ack_id="all")
    compact_acks(spark, one)
    first = eligible(spark, one, AS_OF).select(F.lit("one").alias("topic"), "message_id")
    second = eligible(spark, two, AS_OF).select(F.lit("two").alias("topic"), "message_id")
    return first.union(second)


def save_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every save mode but overwrite appends."""
    topic = Topic(_root(spark, sf_dir, "orders"), f"modes-{uuid.uuid4().hex}")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey")
    for mode in ("append", "error", "errorifexists", "ignore"):
        publish(
            orders, root=topic.root, topic=topic.name, mode=mode, publish_id=mode,
            message_id="o_orderkey",
        )
    stored = read_topic(spark, topic).groupBy("message_id")
    return stored.agg(F.count(F.lit(1)).alias("messages"))


def ack_then_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = _events(spark, sf_dir)
    _ack_type(spark, sf_dir, Subscription.of(options), "view")
    pull = pull_messages(spark, as_of=AS_OF, **options)
    return _envelope_view(pull.messages)


def _leased(spark: SparkSession, sf_dir: str, seconds: int | None) -> DataFrame:
    options = {**_events(spark, sf_dir), "max_messages": 100}
    if seconds is not None:
        options["lease_seconds"] = seconds
    pull = pull_messages(spark, as_of=AS_OF, **options)
    return pull.leased.select("subscription", "message_id", "lease_until")


def lease_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leased(spark, sf_dir, None)


def lease_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leased(spark, sf_dir, 1)


def _mixed_state(spark: SparkSession, sf_dir: str) -> Subscription:
    """Clicks acknowledged, errors leased, views leased until a minute ago."""
    sub = Subscription.of(_events(spark, sf_dir))
    _ack_type(spark, sf_dir, sub, "click")
    _lease_type(spark, sf_dir, sub, "error", AS_OF)
    _lease_type(spark, sf_dir, sub, "view", AS_OF - 300_000)
    return sub


def redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eligible(spark, _mixed_state(spark, sf_dir), AS_OF).select("message_id")


def backlog_of_subscription(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backlog(spark, _mixed_state(spark, sf_dir), AS_OF)


def ack_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two acks that overlap, merged: the stored ranges by their first and last event, and what waits."""
    sub = Subscription.of(_events(spark, sf_dir))
    _ack_type(spark, sf_dir, sub, "click")
    stored = read_topic(spark, sub.topic, positions=True).select(*KEY, _event_id())
    ack_keys(stored.where("event_id % 4 = 0").select(*KEY), sub, ack_id="fourth", acked_at=AS_OF)
    compact_acks(spark, sub)
    ranges = read_acks(spark, sub).select(*FILE_KEY, "from_row", (F.col("to_row") - 1).alias("last_row"))
    first = stored.select(*FILE_KEY, F.col("position").alias("from_row"), F.col("event_id").alias("first_event"))
    last = stored.select(*FILE_KEY, F.col("position").alias("last_row"), F.col("event_id").alias("last_event"))
    found = ranges.join(first, [*FILE_KEY, "from_row"]).join(last, [*FILE_KEY, "last_row"])
    waiting = backlog(spark, sub, AS_OF).select(F.col("messages").alias("waiting"))
    return found.select(
        "first_event", "last_event", (F.col("last_row") - F.col("from_row") + 1).alias("messages")
    ).crossJoin(waiting)


def batch_pull_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pull bounded by the bytes of its payloads."""
    options = {**_events(spark, sf_dir), "max_messages": 1_000_000, "max_bytes": PULL_BYTES}
    return _envelope_view(pull_messages(spark, as_of=AS_OF, **options).messages)


def two_pullers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two pulls at once: together the oldest messages, none of them twice."""
    options = {**_events(spark, sf_dir), "max_messages": 300}
    pulls: list = []

    def pull() -> None:
        pulls.append(pull_messages(spark, as_of=AS_OF, **options))

    _at_once(pull, pull)
    both = pulls[0].messages.unionByName(pulls[1].messages)
    return both.groupBy("message_id").agg(F.count(F.lit(1)).alias("pulls"))


def _at_once(*work: Callable[[], None]) -> None:
    """Run functions side by side; the first error is raised."""
    errors: list[BaseException] = []

    def run(each: Callable[[], None]) -> None:
        try:
            each()
        except BaseException as error:  # noqa: BLE001 - raised below
            errors.append(error)

    threads = [threading.Thread(target=run, args=(w,)) for w in work]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if errors:
        raise errors[0]


def lease_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of 300 leased messages a third is given back, a third is held longer: what waits now and later."""
    options = {**_events(spark, sf_dir), "max_messages": 300}
    sub = Subscription.of(options)
    pull = pull_messages(spark, as_of=AS_OF, **options)
    number = F.col("message_id").cast("bigint") % 3
    pull.modify_lease(10_000, where=number < 2, as_of=AS_OF)
    pull.modify_lease(0, where=number == 0, as_of=AS_OF)
    instants = {"now": AS_OF + 1, "later": AS_OF + 300_000, "at last": AS_OF + 10_000_000}
    waiting = [
        eligible(spark, sub, at).select(F.lit(name).alias("instant"), "message_id") for name, at in instants.items()
    ]
    return waiting[0].union(waiting[1]).union(waiting[2])


def pull_waits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pull that was there before the messages."""
    options = {**_fresh(_root(spark, sf_dir, "events"), f"ev-{uuid.uuid4().hex}"), "max_messages": 100}
    rows = _event_rows(spark, sf_dir).where("event_type = 'click'")
    pulls: list = []

    def pull() -> None:
        pulls.append(pull_messages(spark, as_of=AS_OF, wait_seconds=STREAM_TIMEOUT, **options))

    def publish_later() -> None:
        threading.Event().wait(1)
        publish(rows, root=options["root"], topic=options["topic"], publish_id="late", **_EVENT_MESSAGE)

    _at_once(pull, publish_later)
    return _envelope_view(pulls[0].messages)


# --- streams -------------------------------------------------------------------------------


def _drain(spark: SparkSession, options: dict, out: str, checkpoint: str, **bounds) -> None:
    """Process all that waits, one output directory per call of the handler."""

    def keep(messages: DataFrame, offset: int) -> None:
        messages.write.mode("overwrite").parquet(f"{out}/batch={offset}")

    query = process_stream(
        spark, keep, available_now=True, checkpoint=checkpoint, **options, **bounds
    )
    _finish(query, checkpoint)


def _finish(query, checkpoint: str) -> None:
    if not await_query(query, STREAM_TIMEOUT, checkpoint):
        query.stop()
        raise TimeoutError(f"The stream did not finish in {STREAM_TIMEOUT} s")


def _drained(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(ENVELOPE_SCHEMA).parquet(out)


def stream_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of a subscription that is not acknowledged, and what waits after it."""
    options = _events(spark, sf_dir)
    sub, state = Subscription.of(options), options["state_path"]
    _ack_type(spark, sf_dir, sub, "purchase")
    _drain(spark, options, f"{state}/out", f"{state}/checkpoint")
    left = backlog(spark, sub, AS_OF).select(F.col("messages").alias("left"))
    return _envelope_view(_drained(spark, f"{state}/out")).drop("event_timestamp", "batch").crossJoin(left)


def stream_pull_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches bounded by bytes: every message once, in several batches."""
    options = _events_by_type(spark, sf_dir, "click", "error", others=True)
    state = options["state_path"]
    _drain(spark, options, f"{state}/out", f"{state}/checkpoint", max_bytes=1)
    drained = _drained(spark, f"{state}/out")
    batches = drained.agg((F.max("offset") > 1).alias("several_batches"))
    return drained.select(_event_id()).crossJoin(batches)


def stream_pull_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches bounded by a number of messages, given by the name other connectors use; many are handled at a time."""
    options = _events_by_type(spark, sf_dir, "click", "error", others=True)
    state = options["state_path"]
    bounds = {"messageCountPerBatch": 100, "batches_at_once": BATCHES_AT_ONCE}
    _drain(spark, options, f"{state}/out", f"{state}/checkpoint", **bounds)
    return _drained(spark, f"{state}/out").select(_event_id())


def stream_pull_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of so many messages, cut inside files; the stream fails in the middle and goes on, from there with
    many batches at a time."""
    options = _events_by_type(spark, sf_dir, "click", "error", others=True)
    state, fails = options["state_path"], [3]

    def keep(messages: DataFrame, offset: int) -> None:
        if offset in fails:
            fails.clear()
            raise RuntimeError("the handler fails once")
        messages.write.parquet(f"{state}/out/batch={offset}")

    bounds = {"checkpoint": f"{state}/checkpoint", "max_messages": BATCH_ROWS}
    for at_once in (1, BATCHES_AT_ONCE):
        query = process_stream(spark, keep, available_now=True, batches_at_once=at_once, **bounds, **options)
        try:
            _finish(query, f"{state}/checkpoint")
        except StreamingQueryException:
            if fails:
                raise
    drained = _drained(spark, f"{state}/out")
    by_batch = drained.groupBy("offset").agg(F.count(F.lit(1)).alias("n"))
    batches = by_batch.agg(F.max("offset").alias("batches"), F.max("n").alias("largest"))
    return drained.select(_event_id()).crossJoin(batches)


def stream_fenced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second stream starts while the first one handles a batch: every file is acknowledged by the second."""
    options = _events_by_type(spark, sf_dir, "click", "error", others=True)
    sub, state = Subscription.of(options), options["state_path"]
    entered, released = threading.Event(), threading.Event()

    def slow(messages: DataFrame, offset: int) -> None:
        entered.set()
        released.wait(STREAM_TIMEOUT)

    early = process_stream(spark, slow, available_now=True, checkpoint=f"{state}/early", **options)
    entered.wait(STREAM_TIMEOUT)
    late = process_stream(
        spark, lambda messages, offset: None, available_now=True, checkpoint=f"{state}/late", **options
    )
    _finish(late, f"{state}/late")
    released.set()
    refused = False
    try:
        _finish(early, f"{state}/early")
    except StreamingQueryException as error:
        refused = "FencedError" in str(error)
    acks = read_file_acks(spark, sub).select(*FILE_KEY, F.col("ack_id").startswith(str(late.id)).alias("by_later"))
    stored = read_topic(spark, sub.topic, positions=True).select(*FILE_KEY, _event_id())
    return stored.join(acks, FILE_KEY, "left").select("event_id", "by_later", F.lit(refused).alias("refused"))


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs from one checkpoint, with new publishes in between: every message once."""
    options = _events_by_type(spark, sf_dir, "click", "error")
    state = options["state_path"]
    _drain(spark, options, f"{state}/out", f"{state}/checkpoint", max_files=1)
    _events_by_type(spark, sf_dir, "click", "error", others=True, topic=options["topic"])
    _drain(spark, options, f"{state}/out", f"{state}/checkpoint", max_files=1)
    return _drained(spark, f"{state}/out").select(_event_id())


def stream_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets count batches from 1 without a gap."""
    options = _events_by_type(spark, sf_dir, "click", "error", "view", others=True)
    state = options["state_path"]
    _drain(spark, options, f"{state}/out", f"{state}/checkpoint", max_files=1)
    by_offset = _drained(spark, f"{state}/out").groupBy("offset").agg(
        F.count(F.lit(1)).alias("n")
    )
    return by_offset.agg(
        F.min("offset").alias("first_offset"),
        (F.max("offset") - F.count(F.lit(1))).alias("gaps"),
        (F.count(F.lit(1)) > 1).alias("several_batches"),
        F.sum("n").alias("messages"),
    )


def stream_ack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream leaves out what a batch pull acknowledged, and acknowledges the rest."""
    options = _events(spark, sf_dir)
    sub, state = Subscription.of(options), options["state_path"]
    _ack_type(spark, sf_dir, sub, "purchase")
    _drain(spark, options, f"{state}/out", f"{state}/checkpoint")
    waiting = eligible(spark, sub, AS_OF).select("message_id", F.lit(True).alias("waits"))
    delivered = _drained(spark, f"{state}/out").select("message_id")
    return delivered.join(waiting, "message_id", "full").select(
        _event_id(), F.coalesce("waits", F.lit(False)).alias("waits")
    )


def _stream_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = _table(spark, sf_dir, "orders").schema
    files = spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet")
    return files.parquet(sf_dir)


def _publish_orders(spark: SparkSession, sf_dir: str) -> tuple[Topic, str]:
    topic = Topic(_root(spark, sf_dir, "orders"), f"ord-{uuid.uuid4().hex}")
    checkpoint = f"{topic.root}/checkpoints/{topic.name}"
    query = write_stream_messages(
        _stream_orders(spark, sf_dir),
        root=topic.root,
        topic=topic.name,
        checkpoint=checkpoint,
        payload=["o_orderkey", "o_custkey", "o_orderstatus"],
        message_id="o_orderkey",
        available_now=True,
    )
    _finish(query, checkpoint)
    return topic, str(query.id)


def stream_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic, _ = _publish_orders(spark, sf_dir)
    return read_topic(spark, topic).select("message_id", _text().alias("payload"))


def stream_publish_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first batch published once more under its own name: nothing is added."""
    topic, query_id = _publish_orders(spark, sf_dir)
    publish(
        _table(spark, sf_dir, "orders"),
        root=topic.root,
        topic=topic.name,
        publish_id=f"{query_id}-0",
        payload=["o_orderkey", "o_custkey", "o_orderstatus"],
        message_id="o_orderkey",
    )
    return read_topic(spark, topic).select("message_id", _text().alias("payload"))


# --- pipelines -----------------------------------------------------------------------------


def csv_to_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _root(spark, sf_dir, "orders")
    run = uuid.uuid4().hex
    source = f"{root}/csv/{run}"
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    orders.write.option("header", "false").csv(source)
    checkpoint = f"{root}/checkpoints/{run}"
    query = run_csv_to_topic(
        spark,
        source,
        "orderId int, customerid int",
        root=root,
        topic=f"csv-{run}",
        checkpoint=checkpoint,
        available_now=True,
    )
    _finish(query, checkpoint)
    return read_topic(spark, Topic(root, f"csv-{run}")).select(_text().alias("payload"))


def topic_to_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bounded pull forwarded unchanged."""
    options = {**_events(spark, sf_dir), "max_messages": 1000}
    target = f"forwarded-{uuid.uuid4().hex}"
    run_topic_to_topic(spark, to_topic=target, as_of=AS_OF, **options)
    messages = read_topic(spark, Topic(options["root"], target))
    return _envelope_view(to_envelope(messages, "sub", as_of=AS_OF))


def decode_republish(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = _events(spark, sf_dir)
    state, target = options["state_path"], f"decoded-{uuid.uuid4().hex}"
    query = run_decode_republish(
        spark,
        "event_id bigint, user_id bigint, event_type string",
        to_topic=target,
        checkpoint=f"{state}/checkpoint",
        available_now=True,
        **options,
    )
    _finish(query, f"{state}/checkpoint")
    return read_topic(spark, Topic(options["root"], target)).select(_text().alias("payload"))


def topic_to_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of a subscription that is not acknowledged, as CSV, and what waits after it."""
    options = _events(spark, sf_dir)
    sub, state = Subscription.of(options), options["state_path"]
    _ack_type(spark, sf_dir, sub, "purchase")
    query = run_topic_to_csv(
        spark, f"{state}/csv", checkpoint=f"{state}/checkpoint", available_now=True, **options
    )
    _finish(query, f"{state}/checkpoint")
    fields = (
        "subscription string, offset bigint, data string, publish_timestamp bigint, "
        "event_timestamp bigint, attributes string, message_id string"
    )
    left = backlog(spark, sub, AS_OF).select(F.col("messages").alias("left"))
    rows = spark.read.schema(fields).csv(f"{state}/csv").drop("event_timestamp", "batch")
    return rows.crossJoin(left)


def entry(spark: SparkSession) -> DataFrame:
    """Orders published to a topic, as envelopes."""
    topic = _orders_topic(spark, "/root/testdata/sf0.001")
    return _envelope_view(to_envelope(read_topic(spark, topic), "sub", as_of=AS_OF))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return (_llm.queries() if _llm else {}) | {
        "payload_text": payload_text,
        "payload_text_types": payload_text_types,
        "payload_text_intervals": payload_text_intervals,
        "batch_publish": batch_publish,
        "batch_publish_numbered": batch_publish_numbered,
        "batch_publish_content_ids": batch_publish_content_ids,
        "envelope": envelope,
        "envelope_schema": envelope_schema,
        "attributes_text": attributes_as_text,
        "decode_json": decode_json,
        "decode_avro_schema": decode_avro_schema,
        "decode_csv": decode_csv,
        "batch_pull": batch_pull,
        "batch_pull_limit": batch_pull_limit,
        "read_and_ack": read_and_ack,
        "pull_repeated_ids": pull_repeated_ids,
        "ack_repeated_ids": ack_repeated_ids,
        "two_topics": two_topics,
        "save_modes": save_modes,
        "ack_then_pull": ack_then_pull,
        "lease": lease_default,
        "lease_short": lease_short,
        "lease_changed": lease_changed,
        "ack_ranges": ack_ranges,
        "batch_pull_bytes": batch_pull_bytes,
        "two_pullers": two_pullers,
        "pull_waits": pull_waits,
        "redelivery": redelivery,
        "backlog": backlog_of_subscription,
        "stream_pull": stream_pull,
        "stream_pull_bytes": stream_pull_bytes,
        "stream_pull_count": stream_pull_count,
        "stream_pull_rows": stream_pull_rows,
        "stream_fenced": stream_fenced,
        "stream_restart": stream_restart,
        "stream_offsets": stream_offsets,
        "stream_ack": stream_ack,
        "stream_publish": stream_publish,
        "stream_publish_replay": stream_publish_replay,
        "csv_to_topic": csv_to_topic,
        "topic_to_topic": topic_to_topic,
        "topic_to_topic_repeated_ids": topic_to_topic_repeated_ids,
        "decode_republish": decode_republish,
        "topic_to_csv": topic_to_csv,
    }


_BODY = (
    """'{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type """
    """|| '","value":' || value || '}'"""
)
_ENVELOPE = f"""
    SELECT 'sub' AS subscription, CAST(-1 AS BIGINT) AS "offset", {_BODY} AS data,
           epoch_us(ts) // 1000 AS publish_timestamp, CAST({AS_OF} AS BIGINT) AS event_timestamp,
           '{{k=' || json_extract_string(props, '$.k') || '}}' AS attributes,
           CAST(event_id AS VARCHAR) AS message_id
    FROM events"""
_OLDEST = "ORDER BY ts, message_id LIMIT"
_WAITING = "event_type NOT IN ('click', 'error')"
_ORDER_TEXT = "'[' || o_orderkey || ',' || o_custkey || ',' || o_orderstatus"
_FLAG_ID = "CASE WHEN l_returnflag <> 'R' THEN l_returnflag END"
_FLAG_COPIES = """
    SELECT '[' || l_returnflag || ',' || l_linestatus || ',' || l_linenumber || ']' AS payload,
           count(*) AS messages, count(*) AS ids
    FROM lineitem GROUP BY 1"""


def _lease_sql(millis: int) -> str:
    return f"""
    SELECT 'sub' AS subscription, CAST(event_id AS VARCHAR) AS message_id,
           CAST({AS_OF + millis} AS BIGINT) AS lease_until
    FROM events {_OLDEST} 100"""


def _iso_text(column: str) -> str:
    """The text of a local timestamp: no zero seconds, a fraction of 0, 3 or 6 digits."""
    return f"""CASE
        WHEN microsecond({column}) % 1000 <> 0 THEN strftime({column}, '%Y-%m-%dT%H:%M:%S.%f')
        WHEN microsecond({column}) % 1000000 <> 0 THEN strftime({column}, '%Y-%m-%dT%H:%M:%S.%g')
        WHEN second({column}) <> 0 THEN strftime({column}, '%Y-%m-%dT%H:%M:%S')
        ELSE strftime({column}, '%Y-%m-%dT%H:%M') END"""


def oracle_sql() -> dict[str, str]:
    streamed = f"""
    SELECT subscription, CAST(1 AS BIGINT) AS "offset", data, publish_timestamp, attributes,
           message_id, CAST(0 AS BIGINT) AS "left"
    FROM ({_ENVELOPE} WHERE event_type <> 'purchase')"""
    return (_llm.oracle_sql() if _llm else {}) | {
        "payload_text": f"""
    SELECT o_orderkey, {_ORDER_TEXT} || ',' || {_iso_text("o_orderdate")} || ','
           || o_orderpriority || ']' AS payload
    FROM orders""",
        "payload_text_types": f"""
    SELECT l_orderkey, l_linenumber, '[' || l_orderkey || ',' || l_linenumber
           || ',[' || l_partkey || ',' || l_suppkey || ']'
           || ',WrappedArray(' || l_linenumber || ', null)'
           || ',Map(' || l_returnflag || ' -> ' || CAST(l_quantity AS INT) || ')'
           || ',' || CAST(l_discount AS DECIMAL(6,2))
           || ',' || CASE
                WHEN l_quantity = 0 THEN '0E-8'
                WHEN l_quantity < 10 THEN CAST(l_quantity AS INT) || 'E-8'
                WHEN l_quantity < 100 THEN CAST(l_quantity AS INT) // 10 || '.'
                     || CAST(l_quantity AS INT) % 10 || 'E-7'
                ELSE CAST(CAST(l_quantity AS DECIMAL(18,8)) / 100000000 AS VARCHAR) END
           || ',' || {_iso_text("l_shipdate")}
           || ',' || strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') || '.0'
           || ',null]' AS payload
    FROM lineitem""",
        "batch_publish": f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS message_id,
           {_ORDER_TEXT} || ',' || o_orderpriority || ']' AS payload
    FROM orders""",
        "batch_publish_numbered": _FLAG_COPIES,
        "batch_publish_content_ids": _FLAG_COPIES,
        "envelope": _ENVELOPE,
        "envelope_schema": """
    SELECT position, name, type, messages FROM (VALUES
        (1, 'subscription', 'string'), (2, 'offset', 'bigint'), (3, 'data', 'binary'),
        (4, 'publish_timestamp', 'bigint'), (5, 'event_timestamp', 'bigint'),
        (6, 'attributes', 'string'), (7, 'message_id', 'string')) AS t(position, name, type),
        (SELECT count(*) AS messages FROM events)""",
        "attributes_text": f"SELECT message_id, attributes FROM ({_ENVELOPE})",
        "decode_json": "SELECT event_id, user_id, event_type, value FROM events",
        "decode_avro_schema": "SELECT event_id, user_id, event_type, value FROM events",
        "payload_text_intervals": f"""
    WITH v AS (SELECT l_orderkey, l_linenumber, (l_linenumber - 4) * CAST(l_quantity AS INT) AS m,
                      (l_partkey % 7 - 3) * CAST(l_quantity AS BIGINT) * l_suppkey * 25000 AS u FROM lineitem),
    p AS (SELECT *, abs(u) AS a, CASE WHEN u < 0 THEN '-' ELSE '' END AS s,
                 'P' || CASE WHEN trunc(m / 12) <> 0 THEN CAST(trunc(m / 12) AS INT) || 'Y' ELSE '' END
                 || CASE WHEN m % 12 <> 0 THEN m % 12 || 'M' ELSE '' END AS period FROM v),
    d AS (SELECT *, CASE WHEN a >= 3600000000 THEN s || a // 3600000000 || 'H' ELSE '' END
                 || CASE WHEN a // 60000000 % 60 <> 0 THEN s || a // 60000000 % 60 || 'M' ELSE '' END
                 || CASE WHEN a % 60000000 <> 0 THEN s || a // 1000000 % 60
                      || CASE WHEN a % 1000000 <> 0 THEN '.' || rtrim(lpad(CAST(a % 1000000 AS VARCHAR), 6, '0'), '0')
                         ELSE '' END || 'S' ELSE '' END AS rest FROM p)
    SELECT l_orderkey, l_linenumber, '[' || CASE period WHEN 'P' THEN 'P0D' ELSE period END || ',PT'
           || CASE rest WHEN '' THEN '0S' ELSE rest END || ']' AS payload FROM d""",
        "decode_csv": "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders",
        "batch_pull": f"{_ENVELOPE} {_OLDEST} 10",
        "batch_pull_limit": f"{_ENVELOPE} {_OLDEST} 5000",
        "read_and_ack": f"{_ENVELOPE} {_OLDEST} 100 OFFSET 100",
        "pull_repeated_ids": """
    SELECT epoch_us(l_shipdate) // 1000 AS publish_timestamp, count(*) AS messages
    FROM (SELECT l_shipdate FROM lineitem ORDER BY l_shipdate LIMIT 5000) GROUP BY 1""",
        "ack_repeated_ids": f"""
    SELECT {_FLAG_ID} AS message_id, CAST(l_linenumber AS VARCHAR) AS line, count(*) AS messages
    FROM lineitem WHERE l_linenumber <> 1 GROUP BY 1, 2""",
        "topic_to_topic_repeated_ids": f"""
    SELECT {_FLAG_ID} AS message_id, count(*) AS messages, CAST(0 AS BIGINT) AS "left"
    FROM lineitem GROUP BY 1""",
        "two_topics": "SELECT 'two' AS topic, CAST(o_orderkey AS VARCHAR) AS message_id FROM orders",
        "save_modes": """
    SELECT CAST(o_orderkey AS VARCHAR) AS message_id, CAST(4 AS BIGINT) AS messages FROM orders""",
        "stream_pull_bytes": "SELECT event_id, true AS several_batches FROM events",
        "stream_pull_count": "SELECT event_id FROM events",
        "ack_then_pull": f"{_ENVELOPE} WHERE event_type <> 'view' {_OLDEST} 10",
        "lease": _lease_sql(240_000),
        "lease_short": _lease_sql(1_000),
        "lease_changed": """
    WITH m AS (SELECT event_id, row_number() OVER (ORDER BY ts, CAST(event_id AS VARCHAR)) > 300 AS free FROM events)
    SELECT instant, CAST(event_id AS VARCHAR) AS message_id
    FROM m, (VALUES ('now'), ('later'), ('at last')) AS t(instant)
    WHERE free OR event_id % 3 = 0 OR (instant = 'later' AND event_id % 3 = 2) OR instant = 'at last'""",
        "ack_ranges": """
    WITH a AS (SELECT event_id, event_id - row_number() OVER (ORDER BY event_id) AS island
               FROM events WHERE event_type = 'click' OR event_id % 4 = 0)
    SELECT min(event_id) AS first_event, max(event_id) AS last_event, count(*) AS messages,
           (SELECT count(*) FROM events WHERE event_type <> 'click' AND event_id % 4 <> 0) AS waiting
    FROM a GROUP BY island""",
        "batch_pull_bytes": f"""
    SELECT * EXCLUDE (bytes) FROM (
        SELECT *, sum(strlen(data)) OVER (ORDER BY publish_timestamp, CAST(message_id AS BIGINT)) AS bytes
        FROM ({_ENVELOPE})) WHERE bytes <= {PULL_BYTES}""",
        "two_pullers": f"""
    SELECT message_id, CAST(1 AS BIGINT) AS pulls FROM ({_ENVELOPE} {_OLDEST} 600)""",
        "pull_waits": f"{_ENVELOPE} WHERE event_type = 'click' {_OLDEST} 100",
        "stream_pull_rows": f"""
    SELECT event_id, (n + {BATCH_ROWS - 1}) // {BATCH_ROWS} AS batches, least(n, {BATCH_ROWS}) AS largest
    FROM events, (SELECT count(*) AS n FROM events)""",
        "stream_fenced": "SELECT event_id, true AS by_later, true AS refused FROM events",
        "redelivery": f"""
    SELECT CAST(event_id AS VARCHAR) AS message_id FROM events WHERE {_WAITING}""",
        "backlog": f"""
    SELECT 'sub' AS subscription, count(*) AS messages,
           epoch_us(min(ts)) // 1000 AS oldest_publish_timestamp
    FROM events WHERE {_WAITING}""",
        "stream_pull": streamed,
        "stream_restart": "SELECT event_id FROM events",
        "stream_offsets": """
    SELECT CAST(1 AS BIGINT) AS first_offset, CAST(0 AS BIGINT) AS gaps,
           true AS several_batches, count(*) AS messages
    FROM events""",
        "stream_ack": """
    SELECT event_id, false AS waits FROM events WHERE event_type <> 'purchase'""",
        "stream_publish": f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS message_id, {_ORDER_TEXT} || ']' AS payload
    FROM orders""",
        "stream_publish_replay": f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS message_id, {_ORDER_TEXT} || ']' AS payload
    FROM orders""",
        "csv_to_topic": """
    SELECT '[' || o_orderkey || ',' || o_custkey || ']' AS payload FROM orders""",
        "topic_to_topic": f"{_ENVELOPE} {_OLDEST} 1000",
        "decode_republish": """
    SELECT '[' || event_id || ',' || user_id || ',' || event_type || ']' AS payload
    FROM events""",
        "topic_to_csv": streamed,
    }
