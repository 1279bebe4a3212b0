"""Fill-in-middle: texts cut in three whose parts change places inside their own bytes.

Two cuts part a text into prefix, middle and suffix. They are found by a scan for the bytes that begin
code points. The sentinels are put in front of the parts in a bytearray, and neighbouring parts are
exchanged by rotations, each of which is three reversals in place. Restoring finds the sentinels, turns the
same rotations back and takes the sentinels out, so it gives the text back byte for byte.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from topicflow.llm.common import as_bytes, map_text

# The sentinels of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 1
#: Of 100 texts, how many are transformed, and of 100 of these, how many begin with the suffix.
SHARE, SPM_SHARE = 90, 20


@dataclass(frozen=True)
class Filled:
    """``prefix`` and ``middle`` count code points; None where the text is plain."""

    output: bytes
    form: str
    length: int
    prefix: int | None = None
    middle: int | None = None


def numbers(seed: int, doc_id: object) -> list[int]:
    """Four numbers below 2 ** 32 from a digest of the document's id (an empty one for null)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def code_points(text: bytes) -> int:
    if text.isascii():
        return len(text)
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def offsets(text: bytes, cuts: list[int]) -> list[int]:
    """Where in the bytes so many code points end."""
    if text.isascii():
        return cuts
    begins = np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    return [int(begins[c]) if c < len(begins) else len(text) for c in cuts]


def rotate(data: bytearray, begin: int, cut: int, end: int) -> None:
    """Exchange ``data[begin:cut]`` and ``data[cut:end]`` in place: each is reversed, then both together."""
    view = np.frombuffer(data, np.uint8)
    for a, b in ((begin, cut), (cut, end), (begin, end)):
        half = (b - a) // 2
        head = view[a : a + half].copy()
        view[a : a + half] = view[b - half : b][::-1]
        view[b - half : b] = head[::-1]


def fill(text: bytes, doc_id: object, seed: int = SEED, share: int = SHARE, spm_share: int = SPM_SHARE) -> Filled:
    """The transformed text, its form and its cuts, all from the text and the id."""
    n = code_points(text)
    h = numbers(seed, doc_id)
    if not n or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= share:
        return Filled(text, "plain", n)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = offsets(text, [low, high])
    data = bytearray(text)
    for at, sentinel in ((b, SUFFIX), (a, MIDDLE), (0, PREFIX)):
        data[at:at] = sentinel
    a, b = a + len(PREFIX), b + len(PREFIX) + len(MIDDLE)  # where middle and suffix begin, with sentinels
    rotate(data, a, b, len(data))
    form = "psm"
    if h[3] % 100 < spm_share:
        form = "spm"
        rotate(data, 0, a, a + len(data) - b)
    return Filled(bytes(data), form, n, low, high - low)


def restore(output: bytes, form: str) -> bytes:
    """The text that ``fill`` was given, from its output and form."""
    if form == "plain":
        return output
    data = bytearray(output)
    if form == "spm":
        rotate(data, 0, data.index(PREFIX), data.index(MIDDLE))
    elif form != "psm":
        raise ValueError(f"unknown form {form!r}")
    middle = data.index(MIDDLE)
    suffix = data.index(SUFFIX)
    rotate(data, suffix, middle, len(data))
    after = suffix + len(data) - middle  # where the suffix begins now
    for at, sentinel in ((after, SUFFIX), (suffix, MIDDLE), (0, PREFIX)):
        del data[at : at + len(sentinel)]
    return bytes(data)


def fill_in_middle(docs: DataFrame, seed: int = SEED, share: int = SHARE, spm_share: int = SPM_SHARE) -> DataFrame:
    """``docs`` with ``text`` transformed and new columns ``_n``, ``_form``, ``_prefix_chars``, ``_middle_chars``.

    Cuts and form come from a digest of ``seed`` and ``doc_id``, so a retried task gives the same and rows
    that repeat are transformed alike; a null ``doc_id`` counts as an empty one. ``share`` of 100 texts are
    transformed, and ``spm_share`` of 100 of these begin with the suffix. Empty texts and texts that
    hold a sentinel are plain: they stay as they are, with no cuts. A null text stays null and is plain, with
    ``_n`` 0. Cuts may coincide with each other or the ends; parts are then empty. A text of any length is
    cut as a whole, in memory that follows its length. Other columns pass through; the new ones replace
    columns of their names. An empty table gives no rows.
    """
    docs = docs.drop("_n", "_form", "_prefix_chars", "_middle_chars")
    names = docs.columns

    def start():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            found = [fill(t, i, seed, share, spm_share) for t, i in zip(as_bytes(batch, "text"), ids)]
            outputs = [f.output if ok.is_valid else None for f, ok in zip(found, texts)]
            new = pa.array(outputs, pa.binary()).cast(texts.type)
            columns = [new if n == "text" else batch.column(n) for n in names]
            columns += [
                pa.array([f.length for f in found], pa.int64()),
                pa.array([f.form for f in found], pa.string()),
                pa.array([f.prefix for f in found], pa.int64()),
                pa.array([f.middle for f in found], pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=[*names, "_n", "_form", "_prefix_chars", "_middle_chars"])

        return each

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    new = "_n bigint, _form string, _prefix_chars bigint, _middle_chars bigint"
    return map_text(docs, "text", f"{schema}, {new}", start)


def restored(filled: DataFrame) -> DataFrame:
    """What ``fill_in_middle`` was given, from what it returned: ``text`` as it was, the new columns gone."""
    names = [c for c in filled.columns if c not in ("_n", "_form", "_prefix_chars", "_middle_chars")]

    def start():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column("text")
            old = [
                restore(t, form) if ok.is_valid else None
                for t, form, ok in zip(as_bytes(batch, "text"), batch.column("_form").to_pylist(), texts)
            ]
            text = pa.array(old, pa.binary()).cast(texts.type)
            return pa.RecordBatch.from_arrays([text if n == "text" else batch.column(n) for n in names], names=names)

        return each

    schema = ", ".join(f"`{n}` {filled.schema[n].dataType.simpleString()}" for n in names)
    return map_text(filled, "text", schema, start)


def digests(filled: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars`` and digests of output and restored text, of what
    ``fill_in_middle`` returned. The restored text is rebuilt from the output and the form; null is empty."""

    def start():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            outputs = as_bytes(batch, "text")
            old = [restore(t, form) for t, form in zip(outputs, batch.column("_form").to_pylist())]
            sums = [pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()) for texts in (outputs, old)]
            names = ["doc_id", "_n", "_form", "_prefix_chars", "_middle_chars"]
            columns = [*map(batch.column, names), *sums]
            return pa.RecordBatch.from_arrays(columns, names=[*(n.removeprefix("_") for n in names), "output_sha256", "restored_sha256"])

        return each

    kind = filled.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
        "output_sha256 string, restored_sha256 string"
    )
    return map_text(filled, "text", schema, start)


#: The rows of the query by a SQL engine whose strings are code points.
SQL = f"""
    WITH h AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
                      sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
    u AS (SELECT *, CAST('0x' || substr(d, 1, 8) AS BIGINT) % (n + 1) AS h1,
                 CAST('0x' || substr(d, 9, 8) AS BIGINT) % (n + 1) AS h2,
                 CAST('0x' || substr(d, 17, 8) AS BIGINT) % 100 AS h3,
                 CAST('0x' || substr(d, 25, 8) AS BIGINT) % 100 AS h4 FROM h),
    c AS (SELECT doc_id, t, n, least(h1, h2) AS a, greatest(h1, h2) AS b,
                 CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                        OR h3 >= {SHARE} THEN 'plain'
                      WHEN h4 < {SPM_SHARE} THEN 'spm' ELSE 'psm' END AS form FROM u),
    p AS (SELECT doc_id, t, n, form, a, b, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid,
                 substr(t, b + 1) AS suf FROM c)
    SELECT doc_id, n, form,
           CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t
                  WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                  ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM p"""
