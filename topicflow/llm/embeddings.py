"""Near-duplicate vectors: cross-polytope hashing after fast Hadamard rotations, with multiprobe.

A hash rotates a vector (three rounds of random signs and a Hadamard transform) and takes the nearest
signed axis. A table's bucket joins several hashes; a vector stands in its own bucket and in those
that swap one hash for its second nearest axis. Two vectors that share a bucket are a candidate
pair, and count as linked by their cosine in double precision alone.

Equal vectors are one entry with a count. No pair is written: a bucket is cut into blocks, each pair
of blocks is one matrix product, and it returns for each vector how many it links and the smallest
vector it hangs together with there. A pair that shares several buckets counts in the first only.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.llm.common import parallelism, stored
from topicflow.llm.graph import components

COSINE = 0.9
#: Tables at least; more where the hashes of a bucket are so many that pairs at the bound meet less often.
TABLES = 8
#: Share of the pairs at the cosine bound that meet in a bucket.
RECALL = 0.98
SEED = 11
#: Vectors of a block; a larger bucket is as many blocks as it takes.
BLOCK = 1024


def rotations(size: int, hashes: int, seed: int = SEED) -> np.ndarray:
    """Signs of three rounds for each hash, for vectors padded to ``size``."""
    return np.random.default_rng(seed).choice(np.array([-1.0, 1.0]), (hashes, 3, size))


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    rows, n = x.shape
    step = 1
    while step < n:
        pairs = x.reshape(rows, n // (2 * step), 2, step)
        a, b = pairs[:, :, 0], pairs[:, :, 1]
        x = np.stack((a + b, a - b), axis=2).reshape(rows, n)
        step *= 2
    return x / math.sqrt(n)


def buckets(x: np.ndarray, tables: int, hashes: int, seed: int = SEED) -> np.ndarray:
    """Codes of the buckets of each unit vector: (vectors, tables, 1 + hashes), its own bucket first."""
    size = max(2, 1 << (x.shape[1] - 1).bit_length())
    padded = np.zeros((len(x), size))
    padded[:, : x.shape[1]] = x
    signs = rotations(size, tables * hashes, seed)
    codes = np.zeros((len(x), tables, 1 + hashes), np.int64)
    rows = np.arange(len(x))
    for t in range(tables):
        nearest = np.zeros((hashes, 2, len(x)), np.int64)
        for k in range(hashes):
            y = padded
            for s in signs[t * hashes + k]:
                y = hadamard(y * s)
            order = np.argpartition(-np.abs(y), 1, axis=1)[:, :2]
            swap = np.abs(y[rows, order[:, 0]]) < np.abs(y[rows, order[:, 1]])
            order[swap] = order[swap][:, ::-1]
            for probe in range(2):
                axis = order[:, probe]
                nearest[k, probe] = 2 * axis + (y[rows, axis] < 0)
        for probe in range(1 + hashes):
            code = np.zeros(len(x), np.int64)
            for k in range(hashes):
                code = code * (2 * size) + nearest[k, 1 if k + 1 == probe else 0]
            codes[:, t, probe] = code
    return codes


def hashes_for(vectors: int, size: int) -> int:
    """Hashes of a bucket, so that there are at least eight buckets for each vector."""
    padded = max(2, 1 << (size - 1).bit_length())
    return max(1, math.ceil(math.log(8 * max(vectors, 1)) / math.log(2 * padded)))


def tables_for(hashes: int, size: int, cosine: float = COSINE, recall: float = RECALL) -> int:
    """Tables, at least ``TABLES``, that bring pairs at the bound into a common bucket with ``recall``.

    How often one table does is counted on made pairs, the same ones each time.
    """
    if size < 2 or not 0 < cosine < 1:
        return TABLES
    r = np.random.default_rng(SEED + 1)
    met, tried = 0, 0
    for _ in range(4):
        a, o = r.normal(size=(2, 500, size))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        o -= (o * a).sum(axis=1, keepdims=True) * a
        o /= np.linalg.norm(o, axis=1, keepdims=True)
        x, y = (buckets(v, TABLES, hashes) for v in (a, cosine * a + math.sqrt(1 - cosine**2) * o))
        same = (x[:, :, :, None] == y[:, :, None, :]).any(axis=(2, 3))
        met, tried = met + int(same.sum()), tried + same.size
    rate = max(met, 1) / tried
    return TABLES if rate == 1 else max(TABLES, math.ceil(math.log(1 - recall) / math.log(1 - rate)))


def _units(lists: pa.ListArray, size: int) -> np.ndarray:
    """Vectors of one length, scaled to length 1 in double precision."""
    x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _coded(classes: DataFrame, tables: int, hashes: int) -> DataFrame:
    """``classes`` with ``size`` (the vector's length) and ``codes``: its buckets, table by table."""

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                part = batch.slice(begin, 1000)
                sizes = pc.list_value_length(part.column("embedding")).to_numpy(zero_copy_only=False)
                for size in np.unique(sizes).tolist():
                    rows = part.take(pa.array(np.flatnonzero(sizes == size)))
                    codes = buckets(_units(rows.column("embedding"), size), tables, hashes)
                    codes = codes.reshape(rows.num_rows, -1)
                    edges = pa.array(np.arange(rows.num_rows + 1, dtype=np.int32) * codes.shape[1])
                    yield pa.RecordBatch.from_arrays(
                        [
                            *rows.columns,
                            pa.array(np.full(rows.num_rows, size, np.int32)),
                            pa.ListArray.from_arrays(edges, pa.array(codes.reshape(-1))),
                        ],
                        names=[*rows.schema.names, "size", "codes"],
                    )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    return classes.mapInArrow(run, f"{schema}, size int, codes array<bigint>")


def _roots(linked: np.ndarray) -> np.ndarray:
    """The first member of each member's connected part of a symmetric matrix."""
    roots = np.arange(len(linked))
    reach = linked | np.eye(len(linked), dtype=bool)
    while True:
        least = np.where(reach, roots, len(roots)).min(axis=1)
        least = least[least]
        if (least == roots).all():
            return roots
        roots = least


def _promising(rows: pa.Table, edges: np.ndarray, cosine: float) -> list[int]:
    """The groups of rows (between ``edges``) that hold a link; products of equal groups are one."""
    found = []
    sizes, starts = np.diff(edges), edges[:-1]
    widths = rows.column("size").to_numpy()[starts]
    vectors = rows.column("embedding").combine_chunks()
    for n, width in sorted(set(zip(sizes.tolist(), widths.tolist()))):
        chosen = np.flatnonzero((sizes == n) & (widths == width))
        step = max(1, 1_000_000 // (n * max(n, width)))
        for begin in range(0, len(chosen), step):
            part = chosen[begin : begin + step]
            at = (starts[part][:, None] + np.arange(n)).reshape(-1)
            x = _units(vectors.take(pa.array(at)), width).reshape(len(part), n, width)
            near = np.matmul(x, x.transpose(0, 2, 1)) >= cosine
            near[:, np.arange(n), np.arange(n)] = False
            found += part[near.any(axis=(1, 2))].tolist()
    return sorted(found)


def _links(pairs: DataFrame, cosine: float, tables: int, schema: str) -> DataFrame:
    """``_block`` of every pair of blocks. Rows of one follow one another in a sorted partition, so
    that many small buckets are looked through at once."""
    key = ["size", "table", "bucket", "low", "high"]

    def run(batches):
        waiting: list[pa.Table] = []

        def complete(rows: pa.Table, last: bool) -> tuple[list[pa.RecordBatch], pa.Table]:
            columns = [rows.column(k).to_numpy() for k in key]
            change = np.any([c[1:] != c[:-1] for c in columns], axis=0)
            edges = np.concatenate(([0], np.flatnonzero(change) + 1, [rows.num_rows]))
            if not last:
                edges = edges[:-1]
            out = []
            if len(edges) > 1:
                for g in _promising(rows, edges, cosine):
                    group = rows.slice(edges[g], edges[g + 1] - edges[g])
                    out += _block(group, cosine, tables).to_batches()
            return out, rows.slice(edges[-1])

        for batch in batches:
            waiting.append(pa.Table.from_batches([batch]))
            rows = pa.concat_tables(waiting).combine_chunks()
            out, rest = complete(rows, last=False)
            yield from out
            waiting = [rest]
        if waiting and (rows := pa.concat_tables(waiting).combine_chunks()).num_rows:
            yield from complete(rows, last=True)[0]

    ordered = pairs.repartition(parallelism(pairs.sparkSession), *key).sortWithinPartitions(*key)
    return ordered.mapInArrow(run, schema)


def _block(table: pa.Table, cosine: float, tables: int) -> pa.Table:
    """Links between two blocks of a bucket (or within one), for each of their vectors."""
    order = table.sort_by("class_id")
    ids, copies = order.column("class_id"), order.column("copies").to_numpy()
    n = order.num_rows
    x = _units(order.column("embedding").combine_chunks(), order.column("size")[0].as_py())
    block = order.column("block").to_numpy()
    low, high = order.column("low")[0].as_py(), order.column("high")[0].as_py()
    linked = x @ x.T >= cosine
    linked &= (block[:, None] != block[None, :]) | (low == high)
    np.fill_diagonal(linked, False)
    a, b = np.nonzero(np.triu(linked))
    codes = order.column("codes").combine_chunks().flatten().to_numpy().reshape(n, tables, -1)
    here, bucket = order.column("table")[0].as_py(), order.column("bucket")[0].as_py()
    counts = np.zeros(n, np.int64)
    for begin in range(0, len(a), 65536):
        p, q = a[begin : begin + 65536], b[begin : begin + 65536]
        first = np.ones(len(p), bool)
        for t in range(here + 1):
            same = codes[p, t][:, :, None] == codes[q, t][:, None, :]
            if t < here:
                first &= ~same.any(axis=(1, 2))
            else:
                shared = np.where(same.any(axis=2), codes[p, t], np.iinfo(np.int64).max)
                first &= shared.min(axis=1) == bucket
        counts += np.bincount(p[first], copies[q[first]], n).astype(np.int64)
        counts += np.bincount(q[first], copies[p[first]], n).astype(np.int64)
    roots = _roots(linked)
    useful = np.flatnonzero(linked.any(axis=1))
    return pa.table(
        {
            "class_id": ids.take(pa.array(useful)),
            "links": pa.array(counts[useful]),
            "root": ids.take(pa.array(roots[useful])),
        }
    )


def near_duplicates(
    vectors: DataFrame, cosine: float = COSINE, tables: int | None = None, block: int = BLOCK
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (``vec_id, embedding``).

    ``n_links`` counts the other rows found with a cosine of at least ``cosine``; ``component_id`` is
    the smallest ``vec_id`` that links reach; ``kept`` marks the row that is it. Vectors that are null,
    empty or zero, or hold null or non-finite components, link with nothing and are kept. Vectors of
    different length are not compared. ``tables`` follows the number of hashes, so that recall at the
    bound does not fall as the table grows. Rows that repeat are vectors of their own. Other columns are
    ignored; an empty table gives no rows.
    """
    schema = vectors.schema["vec_id"].dataType.simpleString()
    rows = vectors.select("vec_id", "embedding")
    value = F.col("embedding").cast("array<double>")
    bad = F.exists(value, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    good = ~F.coalesce(bad, F.lit(True)) & F.exists(value, lambda c: c != 0)
    marked = rows.withColumn("good", F.coalesce(good, F.lit(False)) & F.col("vec_id").isNotNull())
    valid = marked.where("good")
    classes = stored(
        valid.groupBy("embedding").agg(F.min("vec_id").alias("class_id"), F.count(F.lit(1)).alias("copies"))
    )
    facts = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("size")).first()
    size = facts["size"] or 1
    hashes = hashes_for(facts["n"] or 0, size)
    tables = tables or tables_for(hashes, size, cosine)
    coded = stored(_coded(classes, tables, hashes))
    per_table = F.size("codes") / F.lit(tables)
    at = coded.select("size", "class_id", per_table.cast("int").alias("probes"), F.posexplode("codes").alias("at", "bucket"))
    key = ["size", "table", "bucket"]
    at = at.select("size", F.floor(F.col("at") / F.col("probes")).cast("int").alias("table"), "bucket", "class_id")
    # buckets of one vector go before any vector is sent
    held = stored(at.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    placed = at.join(held, key).withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"))
    sent = placed.join(coded.select("class_id", "embedding", "copies", "codes"), "class_id")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = sent.select(*key, "class_id", "copies", "embedding", "codes", "block", other)
    pairs = pairs.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    found = stored(_links(pairs, cosine, tables, f"class_id {schema}, links bigint, root {schema}"))
    linked = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    edges = found.where("class_id <> root").select(F.col("class_id").alias("src"), F.col("root").alias("dst"))
    reached = components(edges.distinct()).withColumnRenamed("node", "class_id")
    by_class = classes.join(linked, "class_id", "left").join(reached, "class_id", "left").select(
        "embedding",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "class_id").alias("component_id"),
    )
    members = valid.select("vec_id", "embedding").join(by_class, "embedding")
    members = members.select("vec_id", "n_links", "component_id")
    alone = marked.where("not good").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    out = members.union(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
