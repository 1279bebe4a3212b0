"""One stream a subscription: the query that started last is the one that may acknowledge."""

from __future__ import annotations

from pyspark.sql import SparkSession

from topicflow.options import Subscription
from topicflow.storage import create_once, delete, list_dirs


class FencedError(RuntimeError):
    """Another stream on the subscription started later; this one must not acknowledge any more."""


def _epochs(spark: SparkSession, sub: Subscription) -> list[int]:
    return [int(n.removeprefix("epoch=")) for n in list_dirs(spark, sub.epochs)]


class Fence:
    """The epoch of a query. A later one gets a higher epoch, which is what shuts this one out."""

    def __init__(self, spark: SparkSession, sub: Subscription):
        self.spark, self.sub = spark, sub
        while True:
            before = _epochs(spark, sub)
            self.epoch = max(before, default=0) + 1
            if create_once(spark, f"{sub.epochs}/epoch={self.epoch}", sub.staging):
                break
        for epoch in before:
            delete(spark, f"{sub.epochs}/epoch={epoch}")

    def check(self) -> None:
        """Refuse to go on if a later query has started."""
        latest = max(_epochs(self.spark, self.sub), default=self.epoch)
        if latest > self.epoch:
            raise FencedError(
                f"Stream {self.epoch} on subscription {self.sub.name!r} was followed by stream {latest}; "
                "what it handled last is not acknowledged and goes to the later one"
            )
