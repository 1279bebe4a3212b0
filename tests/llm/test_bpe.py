import hashlib
import random
import tracemalloc

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from topicflow.llm import bpe
from topicflow.llm.common import slices
from topicflow.llm.lexicon import Lexicon, compile_lexicon

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(PATH)


def texts():
    r = random.Random(3)
    parts = ["a", " ", "  ", "\n", "\t", "é", "ß", "日", "1", "½", "'s", "'t", "<|endoftext|>", "\x1c", "\x85", "́", "😀",
             "!!", "x" * 70, " y" * 3, "\r\n", "​", "ab ", " word", " another", " ", " "]
    made = ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(1500)]
    planes = [f"{chr(c)} a{chr(c)}{chr(c)}b {chr(c)}" for c in range(0x2100) if not 0xD800 <= c < 0xE000]
    return [*made, *planes, "", "a" * 5000, "é" * 300, " " * 500, "<|endoftext|>" * 3, "word " * 3000]


def test_lexicon_holds_exactly_its_words():
    r = random.Random(1)
    words = {bytes(r.choices(b"abcd", k=r.randint(1, 7))): [r.randrange(9) for _ in range(3)] for _ in range(800)}
    lexicon = Lexicon(compile_lexicon(words))
    others = [bytes(r.choices(b"abcde", k=r.randint(0, 9))) for _ in range(500)]
    asked = [*words, *others]
    for word, n in zip(asked, lexicon.find(asked).tolist()):
        assert (n >= 0) == (word in words)
        if n >= 0:
            assert lexicon.ids[lexicon.offsets[n] : lexicon.offsets[n + 1]].tolist() == words[word]


def test_lexicon_is_minimal():
    words = {a + b + c: [1] for a in (b"re", b"un") for b in (b"do", b"wind") for c in (b"", b"ing", b"s")}
    # states: start, r, u, fork, d, w, wi, win, before d, end, i, in, accepting end
    assert len(Lexicon(compile_lexicon(words)).accepts) == 13 - 1
    assert Lexicon(compile_lexicon({})).find([b"a", b""]).tolist() == [-1, -1]


@pytest.mark.parametrize("frequent", [[], [b" word", b" another", b"a", b"!!", b" y"]])
def test_ids_and_texts_are_those_of_the_library(library, vocabulary, frequent):
    ids, starts, sizes = vocabulary.merge(frequent)
    lexicon = Lexicon(compile_lexicon({w: ids[a : a + n].tolist() for w, a, n in zip(frequent, starts, sizes)}))
    encoder = bpe.Encoder(vocabulary, lexicon)
    asked = texts()
    ids, counts = encoder.encode(asked)
    decoded, at = encoder.decode(ids, counts), 0
    for text, n, back, expected in zip(asked, counts.tolist(), decoded, library.encode_batch(asked, add_special_tokens=False)):
        assert ids[at : at + n].tolist() == expected.ids, repr(text)
        assert back == library.decode(expected.ids, skip_special_tokens=False)
        at += n


def test_forgetting_changes_nothing(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    encoder = bpe.Encoder(vocabulary, Lexicon(compile_lexicon({})))
    asked = texts()[:50]
    whole = encoder.encode(asked)[0].tolist()
    assert [i for t in asked for i in encoder.encode([t])[0].tolist()] == whole


def test_operator_and_digests(spark, library):
    rows = [(1, "Hello world, hello", "a"), (2, None, "b"), (3, "", "c"), (1, "Hello world, hello", "d"), (4, "x y" * 9000, "e")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    encoded = bpe.encode_decode(df, PATH, lexicon_words=3)
    found = sorted(bpe.digests(encoded).collect())
    for row, (doc_id, text, _) in zip(found, sorted(rows, key=lambda r: r[0])):
        ids = library.encode(text or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert tuple(row) == (doc_id, len(ids), sha(",".join(map(str, ids))), sha(text or ""))
    assert bpe.encode_decode(df.limit(0), PATH).count() == 0


def test_memory_of_a_task_does_not_follow_the_batch(spark, monkeypatch):
    taken = {}
    df = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    monkeypatch.setattr(bpe, "map_text", lambda rows, column, schema, start, *size: taken.update(start=start, size=size) or rows)
    bpe.encode_decode(df, PATH)
    words = [f"{a}{b}" for a in ("hello", "world", "again", "never") for b in range(500)]
    text = " ".join(words[i * 7919 % len(words)] for i in range(600))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(600)), "text": [text] * 600})
    each = taken["start"]()
    each(batch.slice(0, 1))
    tracemalloc.start()
    try:
        for part in slices([batch], "text", *taken["size"]):
            each(part)
        assert tracemalloc.get_traced_memory()[1] < 25_000_000
    finally:
        tracemalloc.stop()
