"""Option names, defaults and checks shared by all entry points."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from typing import Any

# Option names users of queue connectors already know, and ours.
OPTION_ALIASES = {
    "projectid": "root",
    "subscriptionid": "subscription",
    "topicid": "topic",
    "messagecountperbatch": "max_messages",
    "acknowledgetimeduration": "lease_seconds",
    "maxinboundmessagesize": "max_bytes",
    "temppath": "state_path",
    "checkpointlocation": "checkpoint",
    "returnimmediatelywhilepull": "available_now",
}

# Fixed value: an option that says how many rows go into one request; executors write files.
IGNORED_OPTIONS = ("writebatchsize",)

# Defaults.
DEFAULT_MAX_MESSAGES = 10
DEFAULT_MAX_FILES = 1000
DEFAULT_LEASE_SECONDS = 240
DEFAULT_MAX_RECORDS_PER_FILE = 5_000_000

#: Directory of the file table in a publish; scans of the topic pass over names like this.
FILE_TABLE = "_files"

# Save modes that publish; a topic is append-only, so all of them append.
PUBLISHING_MODES = ("append", "error", "errorifexists", "default", "ignore")

_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


def normalize(options: Mapping[str, Any]) -> dict[str, Any]:
    """Options under our names; a known foreign spelling is translated."""
    known: dict[str, Any] = {}
    for name, value in options.items():
        if name.lower().replace("_", "") in IGNORED_OPTIONS:
            continue
        ours = OPTION_ALIASES.get(name.lower().replace("_", ""), name.lower())
        if ours in known:
            raise ValueError(f"Option {ours} is given twice")
        known[ours] = value
    return known


def checked(options: Mapping[str, Any], *allowed: str) -> dict[str, Any]:
    """Normalized options, all of which must be among ``allowed``."""
    known = normalize(options)
    unknown = sorted(set(known) - set(allowed))
    if unknown:
        raise ValueError(f"Unknown option {', '.join(unknown)}; known: {', '.join(allowed)}")
    return known


def required(options: Mapping[str, Any], name: str) -> Any:
    value = options.get(name)
    if value is None or value == "":
        raise ValueError(f"Option {name} is required")
    return value


def checked_name(kind: str, value: str) -> str:
    """Names become directory names, so they are limited to characters safe in any path."""
    if not isinstance(value, str) or not _NAME.fullmatch(value):
        raise ValueError(f"{kind} {value!r} must be letters, digits, '.', '_' or '-'")
    return value


#: What starts a stream: everything that waits and then stop, a fixed interval, or neither.
TRIGGER_OPTIONS = ("checkpoint", "available_now", "interval")

#: What names a subscription.
SUBSCRIPTION_OPTIONS = ("root", "topic", "subscription", "state_path")


def positive(name: str, value: Any) -> int:
    number = int(value)
    if number <= 0:
        raise ValueError(f"Option {name} must be positive, not {value}")
    return number


def check_save_mode(mode: str) -> None:
    """Overwrite is refused; every other save mode publishes."""
    if mode.lower() == "overwrite":
        raise ValueError("A topic is append-only and cannot be overwritten; use a new topic")
    if mode.lower() not in PUBLISHING_MODES:
        raise ValueError(f"Unknown save mode {mode!r}")


def check_output_mode(mode: str) -> None:
    if mode.lower() != "append":
        raise ValueError(f"Output mode {mode!r} is not supported; messages are only appended")


def to_millis(instant: datetime | int | None) -> int:
    """An instant as epoch ms; None is now, a naive datetime is UTC."""
    if instant is None:
        instant = datetime.now(timezone.utc)
    if isinstance(instant, int):
        return instant
    if instant.tzinfo is None:
        instant = instant.replace(tzinfo=timezone.utc)
    return (instant - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(milliseconds=1)


@dataclass(frozen=True)
class Topic:
    """An append-only directory of published messages."""

    root: str
    name: str

    @classmethod
    def of(cls, options: Mapping[str, Any]) -> Topic:
        root = str(required(options, "root")).rstrip("/")
        return cls(root, checked_name("topic", required(options, "topic")))

    @property
    def path(self) -> str:
        return f"{self.root}/topics/{self.name}"

    @property
    def staging(self) -> str:
        return f"{self.root}/_staging/{self.name}"

    @property
    def file_tables(self) -> str:
        """Where the publishes keep their rows of the file table."""
        return f"{self.path}/publish_id=*/{FILE_TABLE}"

    def publish_path(self, publish_id: str) -> str:
        return f"{self.path}/publish_id={checked_name('publish_id', publish_id)}"


@dataclass(frozen=True)
class Subscription:
    """A named view of a topic with its own delivery state."""

    topic: Topic
    name: str
    state_path: str

    @classmethod
    def of(cls, options: Mapping[str, Any]) -> Subscription:
        name = checked_name("subscription", required(options, "subscription"))
        topic = Topic.of(options)
        state = options.get("state_path") or f"{topic.root}/subscriptions/{topic.name}/{name}"
        return cls(topic, name, str(state).rstrip("/"))

    @property
    def acks(self) -> str:
        return f"{self.state_path}/acks"

    @property
    def file_acks(self) -> str:
        return f"{self.state_path}/file_acks"

    @property
    def leases(self) -> str:
        return f"{self.state_path}/leases"

    @property
    def deadlines(self) -> str:
        return f"{self.state_path}/deadlines"

    @property
    def epochs(self) -> str:
        return f"{self.state_path}/epochs"

    @property
    def slices(self) -> str:
        return f"{self.state_path}/slices"

    @property
    def bound(self) -> str:
        return f"{self.state_path}/bound"

    @property
    def superseded(self) -> str:
        return f"{self.state_path}/superseded"

    def finished(self, pull_id: str) -> str:
        return f"{self.state_path}/finished/{checked_name('pull_id', pull_id)}"

    @property
    def retired(self) -> str:
        return f"{self.state_path}/retired"

    @property
    def staging(self) -> str:
        return f"{self.state_path}/_staging"
