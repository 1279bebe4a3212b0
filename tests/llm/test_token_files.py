import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from topicflow.llm import repair as R
from topicflow.llm import token_files as T
from topicflow.llm.common import parts_between_spaces

PATH = public_tokenizers.path("byte_bpe_50k.json")


def encoder():
    with open(PATH, encoding="utf-8") as file:
        return T.Encoder(file.read(), T.Vocabulary(PATH))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def sequences():
    r = np.random.default_rng(5)
    phrase = r.integers(0, 900, 40)
    return {
        "empty": np.zeros(0, np.int64),
        "one": np.array([7]),
        "zeros": np.zeros(1001, np.int64),
        "random": r.integers(0, 50000, 3000),
        "few": r.integers(0, 3, 5000),
        "phrases": np.concatenate([np.concatenate((phrase, r.integers(0, 900, 3))) for _ in range(200)]),
        "runs": np.repeat(r.integers(0, 5, 400), r.integers(1, 30, 400)),
    }


@pytest.mark.parametrize("name", sequences())
@pytest.mark.parametrize("bits", [4, 20])
def test_a_grammar_expands_to_its_ids(name, bits, monkeypatch):
    monkeypatch.setattr(R, "SLOT_BITS", bits)
    ids = sequences()[name]
    g = R.Grammar.of(ids)
    assert np.array_equal(R.expand(g.symbols, g.first, g.rules), ids)
    for rule, n in zip(range(len(g.rules)), g.lengths()):
        assert len(R.expand(np.array([g.first + rule]), g.first, g.rules)) == n
    if name in ("zeros", "phrases"):
        assert len(g.symbols) + 2 * len(g.rules) < len(ids) / 5


def test_no_frequent_pair_is_left_and_rules_are_used():
    """Counted one by one: what is left has no pair of MIN_PAIRS places that do not overlap."""
    ids = sequences()["phrases"]
    g = R.Grammar.of(ids)
    counts, last = {}, {}
    for i, pair in enumerate(zip(g.symbols.tolist(), g.symbols[1:].tolist())):
        if last.get(pair) != i - 1:
            counts[pair] = counts.get(pair, 0) + 1
            last[pair] = i
    assert max(counts.values()) < R.MIN_PAIRS
    used = np.bincount(np.concatenate((g.symbols, g.rules.reshape(-1))), minlength=g.first + len(g.rules))
    assert used[g.first :].min() >= 1


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 25])
def test_numbers_are_packed_and_any_stretch_is_read(bits):
    values = np.random.default_rng(bits).integers(0, 1 << bits, 70000)
    data = np.frombuffer(R.pack(values, bits) + b"\0" * 16, np.uint8)
    for a, b in ((0, 70000), (0, 0), (65530, 65545), (69999, 70000)):
        assert np.array_equal(R.unpack(data, bits, a, b), values[a:b])


def test_every_stretch_of_a_shard_is_decoded():
    r = random.Random(2)
    for name, ids in sequences().items():
        cut = sorted(r.sample(range(len(ids) + 1), min(5, len(ids))))
        sizes = np.diff([0, *cut, len(ids)])
        shard = R.shards(R.write_shard(3, 8, [None, *range(len(sizes) - 1)], sizes, ids) + b"\n")[0]
        assert (shard.part, shard.shard, shard.size, shard.doc_ids[0]) == (3, 8, len(ids), None)
        assert np.array_equal(shard.ids(), ids)
        for _ in range(60):
            a, b = sorted((r.randint(0, len(ids)), r.randint(0, len(ids))))
            assert np.array_equal(shard.ids(a, b), ids[a:b]), name
        for n, (a, b) in enumerate(zip([0, *cut], [*cut, len(ids)])):
            assert np.array_equal(shard.document(n), ids[a:b])
    with pytest.raises(ValueError, match="not a token shard"):
        R.Shard(b"RPG0" + bytes(100))


def test_a_long_rule_is_expanded_step_by_step(monkeypatch):
    monkeypatch.setattr(R, "LONG", 3)
    ids = np.tile(np.arange(50), 40)
    assert np.array_equal(R.Shard(R.write_shard(0, 0, [1], np.array([len(ids)]), ids)).ids(), ids)


def test_ids_are_those_of_the_library(library):
    r = random.Random(3)
    parts = ["a", " ", "  ", "\n", "\t", "é", "ß", "日", "1", "½", "'s", "'t", "<|endoftext|>", "\x1c", "\x85", "́", "😀",
             "!!", "x" * 70, " y" * 3, "\r\n", "​", "ab ", " word", " another", " ", "　", " \n"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(1500)]
    texts += [f"{chr(c)} a{chr(c)}{chr(c)}b {chr(c)}" for c in range(0x2100) if not 0xD800 <= c < 0xE000]
    texts += ["x " + "y" * 99 + " z", "a " + " " * 70 + "b", "a \n" + "c" * 80, "q" * 70 + " r", " lead", "trail ", " "]
    texts += ["", "a" * 5000, "é" * 300, " " * 500, "<|endoftext|>" * 3, "word " * 3000, "no-space\n" * 400, "w " + "\n" * 200000 + "x " + " " * 200000]
    wanted = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for text, ids, own in zip(texts, wanted, encoder().encode(texts)):
        assert np.frombuffer(own, "<u4").tolist() == ids, repr(text)


def test_forgetting_and_the_way_of_merging_change_nothing(monkeypatch):
    texts = ["some words", "other words and some", "x" * 99, "words"]
    whole = encoder().encode(texts)
    exact = encoder()
    exact.ranked = None
    assert exact.encode(texts) == whole
    monkeypatch.setattr(T, "REMEMBERED", 0)
    one = encoder()
    assert [one.encode([t])[0] for t in texts] == whole


ROWS = [(i, f"document {i} says " + "words again and " * (i % 7), "x") for i in range(0, 900, 3)]
ODD = [(5, None, "n"), (7, "", "e"), (None, "no id", "a"), (12, "same id", "b"), (12, "same id", "c"), (12, "other text", "d"),
       (2000, "very long " * 40000, "l"), (-4, "before all", "m")]


def expected(library, rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    return [(i, library.encode(t or "", add_special_tokens=False).ids + [0]) for i, t, _ in order]


def test_files_hold_every_document_in_order(spark, library, tmp_path):
    rows = ROWS + ODD
    df = spark.createDataFrame(rows, "doc_id int, text string, ids string").repartition(5)
    path = str(tmp_path / "tokens")
    T.write(df, path, PATH, shard_ids=700)
    got = sorted(T.read(spark, path).collect(), key=lambda r: (r.part, r.shard, r.nth))
    wanted = expected(library, rows)
    assert [r.doc_id for r in got] == [i for i, _ in wanted]
    assert sorted((str(r.doc_id), r.ids) for r in got) == sorted((str(i), ids) for i, ids in wanted)
    assert len({(r.part, r.shard) for r in got}) > 4  # of 4 tasks, so tasks close shards
    at, starts = 0, {}
    for r in got:
        starts.setdefault(r.doc_id, []).append((at, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes())))
        at += len(r.ids)
    found = {}
    for r in T.digests(spark, path).collect():
        found.setdefault(r.doc_id, []).append((r.start, r.n_tokens, r.ids_crc32))
    assert {i: sorted(x) for i, x in found.items()} == starts
    some = {(r.doc_id, tuple(r.ids)) for r in T.read_some(spark, path, [12, 2000, 99, 4]).collect()}
    assert some == {(i, tuple(ids)) for i, ids in wanted if i in (12, 2000, 99)}


def test_one_id_of_very_many_rows_is_dealt_to_several_tasks(spark, tmp_path):
    df = spark.createDataFrame([(1, f"text {i}") for i in range(4000)], "doc_id bigint, text string")
    T.write(df, str(tmp_path / "t"), PATH)
    assert T.read(spark, str(tmp_path / "t")).select("part").distinct().count() > 1


def test_empty_tables_and_tables_of_empty_texts(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert T.token_files(empty, PATH).collect() == []
    rows = spark.createDataFrame([(2, None), (1, "")], "doc_id bigint, text string")
    crc = zlib.crc32(bytes(4))
    assert sorted(map(tuple, T.token_files(rows, PATH).collect())) == [(1, 0, 1, crc), (2, 1, 1, crc)]


def test_a_part_is_looked_up_once_for_many_texts():
    class Counted(dict):
        asked = 0

        def get(self, *key):
            Counted.asked += 1
            return super().get(*key)

        def __getitem__(self, key):
            Counted.asked += 1
            return super().__getitem__(key)

    asked, own = ["one two three two one two"] * 50, encoder()
    whole = own.encode(asked)
    own.after_space = Counted(own.after_space)
    assert own.encode(asked) == whole and len(set(whole)) == 1
    assert Counted.asked <= 3


def test_parts_between_spaces():
    place, parts, edges = parts_between_spaces(["a b  a", "", "b\n é", " "])
    assert [[parts[n] for n in place[a:b]] for a, b in zip(edges, edges[1:])] == [["a", "b", "", "a"], [""], ["b\n", "é"], ["", ""]]
    assert len(parts) == len(set(parts)) == 5
