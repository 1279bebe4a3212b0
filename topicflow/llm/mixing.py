"""Mixing sources to target weights by Poisson replication, with DataFrame functions only.

Each document of a source is repeated a number of times drawn from the Poisson distribution whose
mean is the repetition rate of its source: target rows of the source over its rows. The draw inverts
the distribution at a number hashed from the document's id, so it depends on nothing else: a
retried task, another partitioning or another order of rows gives the same mixture.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicflow.llm.common import parallelism, stored

SEED = "mix-1"
#: Weights of sources that ``weights`` does not name: rows to this power.
TEMPER = 0.5
#: Largest mean that is inverted at once; a larger one is a sum of draws with equal parts of it.
PART_MEAN = 16.0
#: Terms of the distribution. Beyond 90 a mean of 16 leaves less than 1e-35.
TERMS = 90
#: Sources that may be broadcast; more are joined by a shuffle.
BROADCAST_SOURCES = 10_000
_SCALE = float(1 << 52)


def uniform(*parts: Column | str) -> Column:
    """A number between 0 and 1 from the first 52 bits of a digest; nulls are left out."""
    digest = F.md5(F.concat_ws("|", *parts))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(_SCALE)


def rates(docs: DataFrame, by: str, weights: Mapping[str, float] | None, rows: int | None) -> DataFrame:
    """``source, parts, cdf``: draws a document and the distribution of one draw, for each source.

    ``weights`` are relative; ``rows`` is how many rows the mixture has on average (default: as
    many as ``docs``). A weight of 0 leaves a source out.
    """
    counts = docs.groupBy(F.col(by).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    weight = F.pow(F.col("n").cast("double"), F.lit(TEMPER))
    for name, value in (weights or {}).items():
        weight = F.when(F.col("source") == name, F.lit(float(value))).otherwise(weight)
    weighed = stored(counts.select("source", "n", weight.alias("w")))
    totals = weighed.agg(F.sum("w").alias("w"), F.sum("n").alias("n")).first()
    share = F.col("w") / F.lit(totals["w"] or 1.0)
    mean = share * F.lit(float(rows if rows is not None else totals["n"] or 0)) / F.col("n")
    parts = F.greatest(F.lit(1), F.ceil(mean / PART_MEAN))
    term = F.struct(F.exp(-F.col("m")).alias("p"), F.array(F.exp(-F.col("m"))).alias("c"))
    steps = F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)),
        term,
        lambda s, k: F.struct(
            (s["p"] * F.col("m") / k).alias("p"),
            F.concat(s["c"], F.array(F.element_at(s["c"], -1) + s["p"] * F.col("m") / k)).alias("c"),
        ),
    )
    found = weighed.select("source", mean.alias("mean"), parts.alias("parts"))
    return found.withColumn("m", F.col("mean") / F.col("parts")).select(
        "source", "parts", steps["c"].alias("cdf")
    )


def mix(
    docs: DataFrame,
    by: str = "source",
    weights: Mapping[str, float] | None = None,
    rows: int | None = None,
    seed: str = SEED,
    copy: str | None = None,
) -> DataFrame:
    """``docs`` with each row repeated by its draw, in a global order that is random and repeatable.

    ``copy`` names a column for the number of the repetition, from 1; one of that name in ``docs`` is replaced.
    Rows of a null source are a
    source of their own; rows of one ``doc_id`` get the same draw; the text plays no part, so null,
    empty and long texts are rows like others. An empty table gives no rows. Other columns, of
    whatever names, pass through.

    The order is that of a hashed key, whose first bits also name the partition: keys are even by
    nature, so no sample is drawn first and what is repeated is made once.
    """
    found = stored(rates(docs, by, weights, rows))
    if found.count() <= BROADCAST_SOURCES:
        found = F.broadcast(found)
    kept = [c for c in docs.columns if copy is None or c.lower() != copy.lower()]
    wide = docs.select(F.struct(*[docs[c] for c in kept]).alias("row"))
    drawn = wide.join(found, F.col("row")[by].eqNullSafe(F.col("source"))).select("row", "parts", "cdf")
    part = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("parts").cast("bigint"))).alias("part")
    draws = drawn.select("row", "cdf", part)
    u = uniform(F.lit(seed), F.col("row.doc_id").cast("string"), F.col("part").cast("string"))
    times = F.size(F.filter("cdf", lambda c: c < F.col("u")))
    counted = draws.select("row", "cdf", "part", u.alias("u")).select("row", "part", times.alias("times"))
    copies = counted.where("times > 0").select(
        "row", "part", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("nth")
    )
    key = F.md5(F.concat_ws("|", F.lit(seed), F.col("row.doc_id").cast("string"), "part", "nth"))
    n = parallelism(docs.sparkSession)
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("bigint") * n
    dealt = copies.withColumn("key", key).repartitionById(n, F.shiftright(place, 32).cast("int"))
    ordered = dealt.sortWithinPartitions("key")
    number = [((F.col("part") - 1) * (TERMS + 2) + F.col("nth")).alias(copy)] if copy else []
    return ordered.select(*[F.col("row")[c].alias(c) for c in kept], *number)


#: The whole rows of ``mix(documents, copy="copy")`` by a SQL engine: 52 bits of the same digest, the
#: distribution by its logarithms.
SQL = f"""
    WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
    r AS (SELECT source, pow(n, {TEMPER}) / (SELECT sum(pow(n, {TEMPER})) FROM c)
                 * (SELECT sum(n) FROM c) / n AS mean FROM c),
    s AS (SELECT source, greatest(1, CAST(ceil(mean / {PART_MEAN}) AS BIGINT)) AS parts, mean FROM r),
    p AS (SELECT source, parts, k,
                 sum(exp(-mean / parts + k * ln(mean / parts) - lgamma(k + 1)))
                   OVER (PARTITION BY source ORDER BY k) AS cdf
          FROM s, generate_series(0, {TERMS}) AS g(k)),
    d AS (SELECT d.*, unnest(generate_series(1, parts)) AS part
          FROM documents d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
    u AS (SELECT *, (CAST('0x' || substr(md5('{SEED}|' || doc_id || '|' || part), 1, 13) AS BIGINT)
                      + 0.5::DOUBLE) / {1 << 52}::DOUBLE AS u FROM d),
    t AS (SELECT u.* EXCLUDE (u), count(*) AS times
          FROM u JOIN p ON u.source IS NOT DISTINCT FROM p.source AND p.cdf < u.u GROUP BY ALL)
    SELECT * EXCLUDE (part, nth), (part - 1) * {TERMS + 2} + nth AS copy
    FROM (SELECT * EXCLUDE (times), unnest(generate_series(1, times)) AS nth FROM t)"""
