import hashlib

import duckdb
import pytest
from hypothesis import given
from hypothesis import strategies as st

from topicflow.llm import infill as I


def by_slices(text, doc_id, seed=1, share=90, spm=20):
    """The transformation on a string of code points, written out."""
    d = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(text)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= share:
        return "plain", text, None, None
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm:
        return "spm", f"<S>{suf}<P>{pre}<M>{mid}", a, b - a
    return "psm", f"<P>{pre}<S>{suf}<M>{mid}", a, b - a


@given(st.binary(max_size=40), st.data())
def test_rotation_exchanges_neighbours_in_place(data, draw):
    begin, cut, end = sorted(draw.draw(st.integers(0, len(data))) for _ in range(3))
    buffer = bytearray(data)
    I.rotate(buffer, begin, cut, end)
    assert bytes(buffer) == data[:begin] + data[cut:end] + data[begin:cut] + data[end:]


@given(st.text(alphabet="ab<>PSM é日😀\n\0", max_size=60), st.integers(-5, 10**12), st.sampled_from([0, 50, 100]))
def test_output_and_exact_round_trip(text, doc_id, spm):
    found = I.fill(text.encode(), doc_id, share=95, spm_share=spm)
    assert (found.form, found.output.decode(), found.prefix, found.middle) == by_slices(text, doc_id, share=95, spm=spm)
    assert found.length == len(text) and I.restore(found.output, found.form) == text.encode()


def test_parts_of_sentinels_at_the_cuts():
    for text in ("<", "P><", "<P", "S><M", "<<P>"[:3], "M>" * 9, "<" * 9):
        for doc_id in range(200):
            found = I.fill(text.encode(), doc_id, share=100, spm_share=50)
            assert found.form != "plain" and I.restore(found.output, found.form) == text.encode()


def test_forms_have_their_shares_and_an_unknown_one_is_refused():
    forms = [I.fill(b"some text", i).form for i in range(4000)]
    assert 0.08 < forms.count("plain") / 4000 < 0.12
    assert 0.16 < forms.count("spm") / (4000 - forms.count("plain")) < 0.24
    with pytest.raises(ValueError, match="unknown form"):
        I.restore(b"x", "pms")


ROWS = [
    (1, "plain words", "a", 5), (1, "plain words", "a", 5), (2, None, "b", 6), (3, "", "c", None), (None, "no id", None, 1),
    (4, "holds <S> already", "d", 2), (5, "é日😀" * 50000, "e", 3), (6, "x" * 3_000_000, "f", 4), (7, "\n \0", "g", 9),
]


def frame(spark):
    return spark.createDataFrame(ROWS, "doc_id bigint, text string, _form string, n_chars int")


def test_operator_keeps_columns_and_restores(spark):
    df = frame(spark)
    filled = I.fill_in_middle(df, share=100)
    assert filled.columns == ["doc_id", "text", "n_chars", "_n", "_form", "_prefix_chars", "_middle_chars"]
    rows = {(r.doc_id, r.n_chars): r for r in filled.collect()}
    for doc_id, text, _, other in ROWS:
        r = rows[doc_id, other]
        form, output, a, m = by_slices(text or "", doc_id, share=100)
        assert (r._form, r.text, r._prefix_chars, r._middle_chars) == (form, None if text is None else output, a, m)
        assert r._n == len(text or "")
    back = I.restored(filled)
    assert back.columns == ["doc_id", "text", "n_chars"]
    assert sorted(map(str, back.collect())) == sorted(map(str, df.drop("_form").collect()))
    assert I.fill_in_middle(df.limit(0)).count() == 0 == I.digests(I.fill_in_middle(df.limit(0))).count()


def test_digests_are_those_of_the_sql(spark, tmp_path):
    df = frame(spark)
    df.write.parquet(str(tmp_path / "d"))
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{tmp_path}/d/*.parquet'")
    found = db.execute(I.SQL)
    got = I.digests(I.fill_in_middle(df))
    assert got.columns == [d[0] for d in found.description]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, found.fetchall()))
