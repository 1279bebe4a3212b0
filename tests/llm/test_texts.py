"""Licences, fertility and page extraction."""

import collections
import random
import textwrap

import public_tokenizers
import pytest

from topicflow.llm import dom, extraction, fertility, layouts, licenses

MIT = licenses.SENTENCES


def scan(spark, texts):
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, licenses string")
    return {r.doc_id: r for r in licenses.scan(df).collect()}


def test_every_known_sentence_has_a_trigger():
    for known in licenses.known_sentences():
        assert any(t in known for t in licenses.TRIGGERS), known


def test_rules_over_sentences(spark):
    found = scan(
        spark,
        [
            "Some prose. Released under the MIT License.",
            "x\nThis work is licensed under the GNU General Public License, version 3.\ny",
            "Licensed under CC BY-NC 4.0.\nAll rights reserved.",
            "\n".join([MIT["mit-1"], MIT["mit-2"], "A word of ours.", MIT["mit-3"]]),
            "\n".join([MIT["mit-2"], MIT["mit-1"]]),
            f"{MIT['bsd-1']}\n{MIT['bsd-2']}\n{MIT['bsd-3']}\n{MIT['bsd-4']}",
            "\n".join([MIT["bsd-1"], MIT["bsd-2"], *["other"] * 9, MIT["bsd-3"]]),
            None, "", "A license to print money.", "Released under the MIT License.\n" * 3,
        ],
    )
    assert [found[i].licenses for i in range(11)] == [
        ["MIT"], ["GPL-3.0"], ["CC-BY-NC-4.0", "Proprietary"], ["MIT"], ["MIT"], ["BSD-3-Clause"], [], [], [], [], ["MIT"],
    ]
    assert [m.rule for m in found[3].matches] == ["mit-text"] and found[3].matches[0].last == 3
    assert [m.rule for m in found[4].matches] == ["mit-grant"]
    assert [(m.first, m.last) for m in found[10].matches] == [(0, 0), (1, 1), (2, 2)]
    assert found[2].kinds == ["noncommercial", "proprietary"]
    assert scan(spark, []) == {}


@pytest.mark.parametrize("width", [30, 72, 80])
@pytest.mark.parametrize("leader", ["", "# ", " * ", "// "])
def test_broken_lines(width, leader):
    known, ordered = licenses.known_sentences(), licenses.rules()
    texts = {
        ("MIT", "mit-text"): ["mit-1", "", "mit-2", "", "mit-3"],
        ("BSD-3-Clause", "bsd-3-text"): ["bsd-1", "", "bsd-2", "bsd-3", "bsd-4"],
        ("Apache-2.0", "apache-header"): ["apache-1 apache-2 apache-3"],
        ("GPL-3.0", "gpl-3-header"): ["gpl-1", "", "gpl-2", "gpl-3"],
        ("GPL-2.0", "gpl-2-header"): ["gpl2-1", "", "gpl-2", "gpl-3"],
        ("LGPL-3.0", "lgpl-3-grant"): ["lgpl-1"],
        ("AGPL-3.0", "agpl-3-grant"): ["agpl-1"],
        ("MPL-2.0", "mpl-2-header"): ["mpl-1"],
        ("ISC", "isc-text"): ["isc-1"],
    }
    for (name, rule), parts in texts.items():
        lines = [line for p in parts for line in (textwrap.wrap(" ".join(MIT[k] for k in p.split()), width) or [""])]
        text = "\n".join((leader + line).rstrip() for line in ["Copyright 2020 A. B.", "", *lines, "", "code"])
        found = licenses.match(licenses.find(text, known, licenses.beginnings(known)), ordered)
        assert [(r.license, r.name) for r, _, _ in found] == [(name, rule)], (name, text)


def test_an_empty_line_ends_a_sentence():
    known = licenses.known_sentences()
    begun = licenses.beginnings(known)
    assert licenses.find("Released under the\nMIT License", known, begun) == [(0, "notice:MIT", 1)]
    assert licenses.find("Released under the\n\nMIT License", known, begun) == []
    assert licenses.find("# Released under the\n#\n# MIT License", known, begun) == []
    assert licenses.find("Released under the MIT License\nSecond line", known, begun) == [(0, "notice:MIT", 0)]


def brute_repeats(words, n=8):
    windows = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
    counts = collections.Counter(windows)
    return len({i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(n)})


def test_fertility_counts(spark):
    r = random.Random(2)
    texts = [" ".join(r.choices(["a", "bb", "é#", "d$|"], k=r.randint(0, 60))) for _ in range(60)]
    texts += [None, "", " \n\t", "one\none\n\ntwo\none", " x y", "word " * 40000, "0123456789abcdef" * 40, "ok " + "日本" * 50]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, script string")
    found = {x.doc_id: x for x in fertility.quality(df, public_tokenizers.path("piece_bpe_32k.model")).collect()}
    for i, text, _ in rows:
        raw = (text or "").encode()
        words, x = raw.split(), found[i]
        lines = [l for l in raw.split(b"\n") if l.split()]
        assert x.n_words == len(words) and x.word_chars == sum(len(w.decode()) for w in words)
        assert x.n_symbols == sum(c in "#*$%&|<>" for c in text or "")
        assert x.n_dup_lines == len(lines) - len(set(lines))
        assert x.n_repeat_words == brute_repeats(words)
        assert x.base_failed == (len(words) < 20 or 100 * x.n_repeat_words > 30 * len(words))
        assert not (x.kept and x.base_failed)
    assert fertility.quality(df.limit(0), public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def test_fertility_bands(spark):
    r = random.Random(6)
    good = layouts.Maker(1).words(200)
    keys = " ".join("".join(r.choices("0123456789abcdefzqx", k=64)) for _ in range(40))
    few = " ".join(["alpha"] * 30 + ["beta"] * 30 + [f"w{i}" for i in range(3)] + ["gamma"] * 30)
    odd = " ".join("".join(chr(r.randrange(0x1E00, 0x1EF0)) for _ in range(6)) for _ in range(40))
    df = spark.createDataFrame([(1, good), (2, keys), (3, few), (4, odd)], "doc_id bigint, text string")
    found = {x.doc_id: x for x in fertility.quality(df, public_tokenizers.path("piece_bpe_32k.model")).collect()}
    assert found[1].kept and not any(found[i].kept for i in (2, 3, 4))
    assert [fertility.script_of(t) for t in ("abc", "Привет", "日本", "123", "", "안녕")] == [
        "Latin", "Cyrillic", "Han", "None", "None", "Hangul",
    ]


@pytest.fixture(scope="module")
def model():
    return extraction.model()


def test_unseen_layouts(model):
    wrong = blocks = 0
    for seed in range(50_000, 50_120):
        page, expected = layouts.made(seed)
        got = model.blocks([page])[0]
        a, b = collections.Counter(got), collections.Counter(expected)
        wrong += sum((a - b).values()) + sum((b - a).values())
        blocks += len(expected)
    assert wrong < 0.05 * blocks


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>x</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav><!-- ad <p>no</p> -->
<div class="cookie-notice"><p>We use cookies to improve your visit.</p><button>Yes</button></div>
<article><h1>The &amp; title</h1><p><b>First</b> block &lt;here&gt;,
 with&nbsp;space.<br>and more of it in a line that goes on for a while.<p>Second block that has no end tag and some more words in it.
<p>Third, with a <a href="#">link</a> in it, is the last of all the blocks.</p></article>
<form><label>Mail</label><input name="m"><button>Send</button></form><footer>&copy; Site &middot; Legal</footer>"""


def test_a_page(model):
    assert model.blocks([PAGE])[0] == [
        "The & title", "First block <here>, with space. and more of it in a line that goes on for a while.",
        "Second block that has no end tag and some more words in it.",
        "Third, with a link in it, is the last of all the blocks.",
    ]


def test_choices_are_consistent():
    nodes = dom.parse("<div><p>a</p><p>b</p></div><div><p>c</p></div>")
    leaves = {x.text: i for i, x in enumerate(nodes) if x.text}
    keep, drop = [-0.1] * len(nodes), [-2.0] * len(nodes)
    parent = nodes[nodes[leaves["c"]].parent].parent
    keep[parent], drop[parent] = -9.0, -0.01  # its descendants can't outweigh it
    assert dom.decode(nodes, keep, drop) == ["a", "b"]


def test_extract(spark, model):
    rows = [(1, "u", PAGE, "x"), (2, None, None, "x"), (3, "u", "", "x"), (4, "u", "<p>", "x"), (1, "u", PAGE, "x"),
            (5, "u", "<div>" * 3000 + "text", "x"), (6, "u", "<" * 5000 + "\"'", "x")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    found = extraction.extract(df, model).collect()
    assert sorted(r.page_id for r in found) == [1, 1, 2, 3, 4, 5, 6]
    by_id = {r.page_id: r for r in found}
    assert by_id[1].text.count("\n\n") == 3 and by_id[2].text == by_id[3].text == by_id[4].text == ""
    assert all(r.n_chars == len(r.text) for r in found)
    assert extraction.extract(df.limit(0), model).count() == 0
