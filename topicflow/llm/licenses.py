"""Licence scans: known licence sentences, and ordered rules over their identifiers.

A text is cut into sentences and lines, and each is normalised: lower case, letters and digits only,
one space between words, which drops comment leaders too. Those that follow one another with no empty
line between are also read as one, so a sentence is known however its lines are broken; the longest
known one counts. A normalised sentence that is known has an identifier. A rule is a sequence of
identifiers that names a licence; it matches where its sentences follow one another with no more
than ``GAP`` other sentences between two of them. Longer rules go first, and a sentence serves one
rule only, so the full text of a licence is not also read as its short notices.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from topicflow.llm.common import map_text

#: Other sentences between two sentences of a rule at most.
GAP = 3

#: Names under which notices speak of a licence, and what it allows (fixed values).
NAMES = {
    "MIT": ("permissive", ["mit license", "mit licence", "expat license", "mit"]),
    "Apache-2.0": ("permissive", ["apache license version 2 0", "apache license 2 0", "apache 2 0 license", "apache 2 0"]),
    "BSD-2-Clause": ("permissive", ["bsd 2 clause license", "simplified bsd license", "bsd 2 clause"]),
    "BSD-3-Clause": ("permissive", ["bsd 3 clause license", "new bsd license", "bsd license", "bsd 3 clause"]),
    "ISC": ("permissive", ["isc license", "isc"]),
    "GPL-2.0": ("copyleft", ["gnu general public license version 2", "gpl version 2", "gplv2", "gpl 2 0", "gpl 2 0 only"]),
    "GPL-3.0": ("copyleft", ["gnu general public license version 3", "gpl version 3", "gplv3", "gpl 3 0", "gpl 3 0 only"]),
    "LGPL-3.0": ("copyleft", ["gnu lesser general public license version 3", "lgplv3", "lgpl 3 0"]),
    "AGPL-3.0": ("copyleft", ["gnu affero general public license version 3", "agplv3", "agpl 3 0"]),
    "MPL-2.0": ("copyleft", ["mozilla public license version 2 0", "mozilla public license 2 0", "mpl 2 0"]),
    "CC0-1.0": ("permissive", ["cc0 1 0", "cc0", "creative commons zero"]),
    "CC-BY-4.0": ("permissive", ["cc by 4 0", "creative commons attribution 4 0 international license"]),
    "CC-BY-SA-4.0": ("copyleft", ["cc by sa 4 0", "creative commons attribution sharealike 4 0 international license"]),
    "CC-BY-NC-4.0": ("noncommercial", ["cc by nc 4 0", "creative commons attribution noncommercial 4 0 international license"]),
    "CC-BY-ND-4.0": ("noderivatives", ["cc by nd 4 0", "creative commons attribution noderivatives 4 0 international license"]),
    "CC-BY-NC-SA-4.0": ("noncommercial", ["cc by nc sa 4 0"]),
    "Unlicense": ("permissive", ["unlicense"]),
    "Proprietary": ("proprietary", []),
}
#: How a notice goes; ``{}`` is a name (fixed values).
NOTICES = [
    *(f"{subject}{verb} under {article}{{}}" for subject in ("", "this work is ", "this file is ", "this software is ", "this program is ", "this project is ", "the code is ")
      for verb in ("licensed", "released", "distributed", "available") for article in ("", "the ", "a ")),
    "spdx license identifier {}", "license {}", "licence {}",
]
#: Sentences of licence texts (fixed values), by an identifier of our own.
SENTENCES = {
    "mit-1": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-2": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-3": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "bsd-1": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-2": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-3": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-4": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "apache-1": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-2": "you may not use this file except in compliance with the License.",
    "apache-3": "You may obtain a copy of the License at",
    "gpl-1": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-2": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "gpl-3": "See the GNU General Public License for more details.",
    "gpl2-1": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "lgpl-1": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl-1": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "mpl-1": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense-1": "This is free and unencumbered software released into the public domain.",
    "isc-1": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "rights-1": "All rights reserved.",
}
#: Words one of which every known sentence holds; a text without any has no known sentence. No two
#: words, as a line may end between them.
TRIGGERS = ("licens", "licenc", "spdx", "reserved", "permission", "copyright", "redistribut", "warranty", "distributed", "released", "available", "unencumbered")


@dataclass(frozen=True)
class Rule:
    name: str
    license: str
    sentences: tuple[str, ...]


_OTHER = re.compile(r"[\W_]+")
_END = re.compile(r"(\n+|(?<=[.!?;:])\s+)")


def normalise(sentence: str) -> str:
    return _OTHER.sub(" ", sentence.lower()).strip()


def sentences(text: str) -> list[str]:
    """Sentences of a text: they end at a line's end, or at a mark before white space."""
    return [s for s, _ in pieces(text)]


def pieces(text: str) -> list[tuple[str, bool]]:
    """Sentences of a text, and whether an empty line stands before each."""
    parts, found, apart = _END.split(text), [], False
    for i, s in enumerate(parts):
        if not s or s.isspace():
            apart = apart or s.count("\n") > 1 or (i % 2 == 0 and bool(s))
        else:
            found.append((s, apart))
            apart = False
    return found


def beginnings(known: dict[str, str]) -> set[str]:
    """What known sentences begin with, whole words at a time."""
    return {" ".join(words[:n]) for k in known for words in [k.split()] for n in range(1, len(words) + 1)}


def find(text: str, known: dict[str, str], begun: set[str]) -> list[tuple[int, str, int]]:
    """Known sentences of a text: position of the first part, identifier, position of the last part."""
    parts = [(normalise(s), apart) for s, apart in pieces(text)]
    found, i = [], 0
    while i < len(parts):
        joined, best = parts[i][0], None
        for j in range(i, len(parts)):
            if j > i:
                if parts[j][1] or not parts[j][0]:
                    break
                joined += " " + parts[j][0]
            if joined in known:
                best = (i, known[joined], j)
            if joined not in begun:
                break
        if best:
            found.append(best)
        i = best[2] + 1 if best else i + 1
    return found


def known_sentences() -> dict[str, str]:
    """Identifier of each known normalised sentence."""
    known = {}
    for spdx, (_, names) in NAMES.items():
        for i, name in enumerate(names):
            for j, notice in enumerate(NOTICES):
                known.setdefault(notice.format(name), f"notice:{spdx}")
    return known | {normalise(s): i for i, s in SENTENCES.items()}


def rules() -> list[Rule]:
    """Rules, longest first; ties as written."""
    texts = [
        Rule("mit-text", "MIT", ("mit-1", "mit-2", "mit-3")),
        Rule("mit-grant", "MIT", ("mit-1",)),
        Rule("bsd-3-text", "BSD-3-Clause", ("bsd-1", "bsd-2", "bsd-3", "bsd-4")),
        Rule("bsd-2-text", "BSD-2-Clause", ("bsd-1", "bsd-2", "bsd-3")),
        Rule("apache-header", "Apache-2.0", ("apache-1", "apache-2", "apache-3")),
        Rule("gpl-3-header", "GPL-3.0", ("gpl-1", "gpl-2", "gpl-3")),
        Rule("gpl-3-grant", "GPL-3.0", ("gpl-1",)),
        Rule("gpl-2-header", "GPL-2.0", ("gpl2-1", "gpl-2", "gpl-3")),
        Rule("gpl-2-grant", "GPL-2.0", ("gpl2-1",)),
        Rule("lgpl-3-grant", "LGPL-3.0", ("lgpl-1",)),
        Rule("agpl-3-grant", "AGPL-3.0", ("agpl-1",)),
        Rule("mpl-2-header", "MPL-2.0", ("mpl-1",)),
        Rule("unlicense-text", "Unlicense", ("unlicense-1",)),
        Rule("isc-text", "ISC", ("isc-1",)),
        Rule("rights-reserved", "Proprietary", ("rights-1",)),
    ]
    notices = [Rule(f"notice-{s}", s, (f"notice:{s}",)) for s, (_, names) in NAMES.items() if names]
    return sorted(texts + notices, key=lambda r: -len(r.sentences))


def match(found: list[tuple[int, str, int]], ordered: list[Rule], gap: int = GAP) -> list[tuple[Rule, int, int]]:
    """Rules in the known sentences of a text (see ``find``), with first and last position."""
    free = dict(enumerate(found))
    out = []
    for rule in ordered:
        again = True
        while again:
            again = False
            for start in sorted(free):
                if free[start][1] != rule.sentences[0]:
                    continue
                path = [start]
                for wanted in rule.sentences[1:]:
                    last = free[path[-1]][2]
                    step = next(
                        (k for k in sorted(free) if k > path[-1] and free[k][1] == wanted and free[k][0] - last <= gap + 1),
                        None,
                    )
                    if step is None:
                        break
                    path.append(step)
                if len(path) == len(rule.sentences):
                    out.append((rule, free[path[0]][0], free[path[-1]][2]))
                    for k in path:
                        del free[k]
                    again = len(rule.sentences) > 1
                    if again:
                        break
    return sorted(out, key=lambda m: (m[1], m[2], m[0].name))


def scan(docs: DataFrame, gap: int = GAP) -> DataFrame:
    """``doc_id, licenses, kinds, matches`` of every row of ``docs`` (``doc_id, text``).

    ``licenses`` and ``kinds`` are sorted and without repeats; ``matches`` has licence, rule and the
    first and last sentence of each match, counted from 0 (a line of a broken sentence counts as one). Null and empty texts have none. Rows
    that repeat get equal results; other columns are ignored; an empty table gives no rows.
    """
    known, ordered = known_sentences(), rules()
    begun = beginnings(known)

    def start():
        def look(text: str) -> list[tuple[Rule, int, int]]:
            lower = text.lower()
            if not any(t in lower for t in TRIGGERS):
                return []
            return match(find(text, known, begun), ordered, gap)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [look(t or "") for t in batch.column("text").to_pylist()]
            names = [sorted({r.license for r, _, _ in f}) for f in found]
            kinds = [sorted({NAMES[n][0] for n in ns}) for ns in names]
            matches = [[{"license": r.license, "rule": r.name, "first": a, "last": b} for r, a, b in f] for f in found]
            kind = pa.list_(pa.struct([("license", pa.string()), ("rule", pa.string()), ("first", pa.int32()), ("last", pa.int32())]))
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.list_(pa.string())), pa.array(kinds, pa.list_(pa.string())), pa.array(matches, kind)],
                names=["doc_id", "licenses", "kinds", "matches"],
            )

        return each

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, licenses array<string>, kinds array<string>, "
        "matches array<struct<license:string,rule:string,first:int,last:int>>"
    )
    return map_text(docs.select("doc_id", "text"), "text", schema, start)
