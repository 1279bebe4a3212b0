import random
import zlib

import numpy as np
import pytest

from topicflow.llm import ordinal as O
from topicflow.llm import toxicity as T

R = random.Random(8)
WORDS = ["".join(R.choices("abcdefghij", k=R.randint(2, 8))) for _ in range(800)]


def corpus(n=1500):
    rows, labels = [], []
    for i in range(n):
        words = R.choices(WORDS, k=R.randint(5, 80))
        toxic = i % 6 == 0
        junk = i % 5 == 1
        if toxic:
            words.insert(R.randrange(len(words)), R.choice(["idiot", "Moron!!", "scumbag,", "zzzorak", "zzzorin", "zzzorum"]))
        if junk:
            words = [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words), "en"))
        labels.append((i, 0 if junk else 1, int(toxic)))
    odd = [(n, None, "en"), (n + 1, "", "en"), (n + 2, "word " * 50000, "en"), (n + 3, "\x00 ퟿ é", "en")]
    return rows + odd, labels


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_toxicity_on_held_out_rows(spark, tables):
    docs, labels = tables
    machine = T.fit(docs, labels)
    found = {r.doc_id: r for r in T.score(docs, machine).collect()}
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found.values())
    assert all(r.held_out == held(i) for i, r in found.items())
    assert all(r.predicted == int(r.score >= 0.3) for r in found.values())
    test = [(r.toxic, found[r.doc_id].predicted) for r in labels.collect() if held(r.doc_id)]
    assert np.mean([p for y, p in test if y]) > 0.9 and np.mean([p for y, p in test if not y]) < 0.05
    clean = T.keep_clean(docs, machine)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, r in found.items() if not r.predicted}


def test_held_out_labels_change_nothing(spark, tables):
    docs, labels = tables
    flipped = labels.selectExpr("doc_id", "quality", "if(crc32(cast(string(doc_id) as binary)) % 4 = 2, 1 - toxic, toxic) as toxic")
    one, two = T.fit(docs, labels), T.fit(docs, flipped)
    assert one.rows == two.rows and np.array_equal(one.weights, two.weights) and np.array_equal(one.vectors, two.vectors)


def test_pairs_of_terms_count():
    machine = T.Machine(-1.0, {5: 0, 6: 1}, np.array([0.1, 0.2]), np.array([[1.0, 0, 0, 0], [2.0, 0, 0, 0]]))
    assert machine.logit([0]) == pytest.approx(-0.9) and machine.logit([0, 1]) == pytest.approx(-0.7 + 2.0)


def test_pairs_are_learned(spark):
    """An insult alone and a group alone are fine; both together are not."""
    rows, labels = [], []
    for i in range(1600):
        a, b = i % 2, i // 2 % 2
        rows.append((i, " ".join([*R.choices(WORDS, k=6), *["insult"] * a, *["people"] * b])))
        labels.append((i, 1, a & b))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    machine = T.fit(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    found = {r.doc_id: r.predicted for r in T.score(docs, machine).collect()}
    assert np.mean([found[i] == y for i, _, y in labels if held(i)]) > 0.95


@pytest.mark.parametrize("rows", [[], [(1, 1, 0)], [(1, 1, None)], [(None, 1, 1)]])
def test_few_labels(spark, tables, rows):
    docs, _ = tables
    labels = spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
    scores = {r.score for r in T.score(docs, T.fit(docs, labels)).collect()}
    assert len(scores) == 1
    grades = O.grade(docs, O.fit(docs, O.graded(labels)))
    assert grades.select("expected_grade").distinct().count() == 1


def test_empty_tables(spark, tables):
    docs, labels = tables
    machine = T.fit(docs.limit(0), labels)
    assert T.score(docs.limit(0), machine).count() == 0
    assert O.grade(docs.limit(0), O.fit(docs.limit(0), O.graded(labels.limit(0)))).count() == 0


def test_ordinal_grades_on_held_out_rows(spark, tables):
    docs, labels = tables
    grader = O.fit(docs, O.graded(labels))
    assert len(grader.thresholds) == 2 and grader.thresholds[0] <= grader.thresholds[1]
    found = {r.doc_id: r for r in O.grade(docs, grader).collect()}
    assert all(r.tails[0] >= r.tails[1] and r.expected_grade == pytest.approx(sum(r.tails)) for r in found.values())
    test = [(r.quality, found[r.doc_id].selected) for r in labels.collect() if held(r.doc_id)]
    assert np.mean([s == bool(q) for q, s in test]) > 0.95


def test_shapes():
    assert [O.shape(w) for w in (b"THE!!!", b"abc,", b"x1234y", b"", "Él".encode())] == ["XX!!", "xx,", "x99x", "", "Xx"]
