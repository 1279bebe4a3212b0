"""Main text of web pages: boosted trees over nodes of the document tree, and a consistent choice.

The trees learn from pages of ``layouts``, whose main text is known by construction: ``PAGES`` of
them, made from a seed, so that the model is the same in every run and no table is needed.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.llm import boosting, dom, layouts
from topicflow.llm.common import map_text

#: Pages that the trees learn from.
PAGES = 1200


@dataclass
class Model:
    tags: dict[str, float]
    tokens: dict[str, float]
    forest: boosting.Forest

    def blocks(self, pages: list[str]) -> list[list[str]]:
        """Blocks of main text of each page."""
        trees = [dom.parse(p) for p in pages]
        rows = [row for t in trees for row in dom.features(t, self.tags, self.tokens)]
        logit = np.clip(self.forest.logit(np.array(rows, float)), -20, 20)
        keep, drop = (-np.log1p(np.exp(-logit))).tolist(), (-np.log1p(np.exp(logit))).tolist()
        out, at = [], 0
        for t in trees:
            out.append(dom.decode(t, keep[at : at + len(t)], drop[at : at + len(t)]))
            at += len(t)
        return out


def labelled(nodes: list[dom.Node], blocks: list[str]) -> list[bool]:
    """Whether each node holds main text, given the blocks in page order."""
    out, at = [False] * len(nodes), 0
    for i, x in enumerate(nodes):
        if x.text and at < len(blocks) and x.text == blocks[at]:
            out[i], at = True, at + 1
    for i in range(len(nodes) - 1, 0, -1):
        out[nodes[i].parent] |= out[i]
    return out


def _odds(pairs: list[tuple[str, bool]], prior: float) -> dict[str, float]:
    counts: dict[str, list[float]] = defaultdict(lambda: [prior, prior])
    for name, label in pairs:
        counts[name][label] += 1
    return {k: float(np.log(yes / no)) for k, (no, yes) in counts.items()}


@lru_cache(maxsize=2)
def model(pages: int = PAGES) -> Model:
    """The model; the same for every call, learned on the driver in 6 to 17 seconds, once a session."""
    trees, labels = [], []
    for seed in range(pages):
        page, blocks = layouts.made(seed)
        trees.append(dom.parse(page))
        labels.append(labelled(trees[-1], blocks))
    nodes = [(x, l) for t, ls in zip(trees, labels) for x, l in zip(t, ls)]
    tags = _odds([(x.tag, l) for x, l in nodes], 5.0)
    tokens = _odds([(t, l) for x, l in nodes for t in x.tokens], 2.0)
    rows = np.array([r for t in trees for r in dom.features(t, tags, tokens)], float)
    return Model(tags, tokens, boosting.fit(rows, np.array([l for ls in labels for l in ls], float)))


def extract(pages: DataFrame, learned: Model | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages`` (``page_id, url, html``).

    ``text`` joins the blocks of main text in page order by an empty line; white space inside a block is
    one space and character references are decoded. Null and empty pages, and pages without
    main text, give an empty text. Pages are read whole, in time proportional to their length however long or
    broken they are; a task holds a few at a time. Rows that repeat get equal texts; other columns are ignored;
    an empty table gives no rows.
    """
    shared = pages.sparkSession.sparkContext.broadcast(learned or model())

    def start():
        learned = shared.value

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = learned.blocks([p or "" for p in batch.column("html").to_pylist()])
            texts = pa.array(["\n\n".join(b) for b in found], pa.string())
            return pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), texts], names=["page_id", "url", "text"]
            )

        return each

    kind = pages.schema["page_id"].dataType.simpleString()
    url = pages.schema["url"].dataType.simpleString()
    texts = map_text(pages.select("page_id", "url", "html"), "html", f"page_id {kind}, url {url}, text string", start)
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))
