"""License scans: templates with optional and replaceable regions, compiled into token automata.

Plan. One pass without a shuffle. A template's text is words and markup: ``<<beginOptional>> ... <<endOptional>>`` may be missing,
``<<var;max=N>>`` stands for up to N words of any kind. It becomes a nondeterministic automaton over words whose subsets are
turned into deterministic states as texts need them. A text is tried only against templates whose longest mandatory word it
has, and only from places where a first word of the template stands; a match has all mandatory wording, in order, exactly.
Whole licences are templates in ``licence_texts``, one a file, whose list markers are optional.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from importlib.resources import files

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ALNUM_TABLE, alnum_words, appended, carried, table

# Fixed values: (words, label) of the base.
BASE = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]

_OPT, _END = " <<beginOptional>> ", " <<endOptional>> "
_VERSION = _OPT + "version" + _END + _OPT + "v" + _END
_WARRANTY = """without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a
 particular purpose and noninfringement in no event shall <<var;max=8>> be liable for any claim damages or other liability whether in
 an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"""
_BSD_CONDITIONS = """redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are
 met <<var;max=1>> redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer <<var;max=1>>
 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or
 other materials provided with the distribution"""
_BSD_WARRANTY = """this software is provided by <<var;max=12>> as is and any express or implied warranties including but not limited to the implied warranties of
 merchantability and fitness for a particular purpose are disclaimed in no event shall <<var;max=12>> be liable for any direct indirect incidental special exemplary or
 consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on
 any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the
 possibility of such damage"""
#: Texts of licences (template, label): what is replaceable or optional is marked, all else must stand there.
TEXTS = [
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without"
        " limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"
        " the above copyright notice and this permission notice" + _OPT + "including the next paragraph" + _END + "shall be included in all copies or substantial portions of the software the software is provided as is " + _WARRANTY,
        "mit-text",
    ),
    (
        "permission to use copy modify and" + _OPT + "or" + _END + "distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"
        " the software is provided as is and <<var;max=6>> disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall <<var;max=6>> be liable for any special direct"
        " indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or"
        " performance of this software",
        "isc-text",
    ),
    (_BSD_CONDITIONS + " " + _BSD_WARRANTY, "bsd-2-clause-text"),
    (
        _BSD_CONDITIONS + " <<var;max=1>> neither the name of <<var;max=12>> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission " + _BSD_WARRANTY,
        "bsd-3-clause-text",
    ),
    (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at" + _OPT + "http www apache org licenses license 2 0" + _END
        + _OPT + "https www apache org licenses license 2 0" + _END + "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"
        " either express or implied see the license for the specific language governing permissions and limitations under the license",
        "apache-2.0-notice",
    ),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version <<var;max=1>> of the license or"
        + _OPT + "at your option" + _END + "any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"
        " see the gnu general public license for more details",
        "gpl-notice",
    ),
    (
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software"
        " for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
        "zlib",
    ),
]
#: (template, label) of the method: wording of notices that are in public use.
TEMPLATES = TEXTS + [
    ("apache license" + _VERSION + "2" + _OPT + "0" + _END, "apache-2.0"),
    ("gnu general public license" + _OPT + "gpl" + _END + _VERSION + "2" + _OPT + "0" + _END, "gpl-2.0"),
    ("gnu general public license" + _OPT + "gpl" + _END + _VERSION + "3" + _OPT + "0" + _END, "gpl-3.0"),
    ("gnu general public license as published by the free software foundation either version <<var;max=2>> of the license or" + _OPT + "at your option" + _END + "any later version", "gpl-or-later"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license" + _VERSION + "2" + _OPT + "0" + _END, "mpl-2.0"),
    ("cc by" + _OPT + "license" + _END + _VERSION + "4" + _OPT + "0" + _END, "cc-by-4.0"),
    ("cc by nc" + _VERSION + "4" + _OPT + "0" + _END, "cc-by-nc-4.0"),
    ("cc by sa" + _VERSION + "4" + _OPT + "0" + _END, "cc-by-sa-4.0"),
    ("cc by nc sa" + _VERSION + "4" + _OPT + "0" + _END, "cc-by-nc-sa-4.0"),
    ("creative commons attribution" + _OPT + "license" + _END + _VERSION + "4 0" + _OPT + "international" + _END, "cc-by-4.0"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software" + _OPT + "and associated documentation files" + _END + _OPT + "the software" + _END + "to deal in the software without restriction", "mit"),
    ("permission to use copy modify and" + _OPT + "or" + _END + "distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("neither the name of <<var;max=12>> nor the names of its contributors may be used to endorse or promote products", "bsd-3-clause"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    (_OPT + "copyright <<var;max=8>>" + _END + "all rights reserved", "all-rights-reserved"),
]


def whole_texts() -> list[tuple[str, str]]:
    """(template, label ``<licence>-text``) of whole licences, by name; read where they are compiled first, and sent to tasks as text."""
    out = []
    for path in sorted((p for p in files(__package__).joinpath("licence_texts").iterdir() if p.name.endswith(".txt")), key=lambda p: p.name):
        parts = re.split(r"(<<[^>]*>>)", path.read_text("utf-8"))
        words = (x if x.startswith("<<") else b" ".join(alnum_words(x.encode())).decode() for x in parts)
        out.append((" ".join(w for w in words if w), path.name.removesuffix(".txt") + "-text"))
    return out


def all_templates() -> list[tuple[str, str]]:
    return TEMPLATES + whole_texts()


@dataclass
class Template:
    """A compiled template. States are numbers; ``step`` has word moves, ``any_`` moves by any word, ``empty`` moves without one."""

    text: str
    label: str
    base: bool = False
    step: list[dict[bytes, int]] = field(default_factory=list)
    any_: list[int | None] = field(default_factory=list)
    empty: list[list[int]] = field(default_factory=list)

    def __post_init__(self):
        mandatory, stack, at = [], [], self._state()
        self.start = at
        for mark, most, word in re.findall(r"<<(beginOptional|endOptional|var;max=(\d+))>>|([^\s<>]+)", self.text):
            if mark == "beginOptional":
                stack.append(at)
            elif mark == "endOptional":
                if not stack:
                    raise ValueError(f"endOptional without beginOptional: {self.text}")
                last, at = at, self._state()
                self.empty[last].append(at)
                self.empty[stack.pop()].append(at)
            elif most:
                end = self._state()
                for _ in range(int(most)):
                    self.empty[at].append(end)
                    after = self._state()
                    self.any_[at], at = after, after
                self.empty[at].append(end)
                at = end
            else:
                after = self._state()
                self.step[at][word.encode()] = after
                at = after
                if not stack:
                    mandatory.append(word.encode())
        if stack or not mandatory:
            raise ValueError(f"a region is open or nothing is mandatory: {self.text}")
        self.accept, self.anchor = at, b" " + max(mandatory, key=len) + b" "
        self.words = {w for moves in self.step for w in moves}
        self.moves: dict[tuple[frozenset, bytes | None], frozenset] = {}
        self.first = self.closure({self.start})
        self.starts = {w for s in self.first for w in self.step[s]}
        if any(self.any_[s] is not None for s in self.first):
            raise ValueError(f"a template begins with wording: {self.text}")

    def _state(self) -> int:
        self.step.append({})
        self.any_.append(None)
        self.empty.append([])
        return len(self.step) - 1

    def closure(self, states: set[int]) -> frozenset:
        todo, out = list(states), set(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in out:
                    out.add(s)
                    todo.append(s)
        return frozenset(out)

    def move(self, states: frozenset, word: bytes) -> frozenset:
        key = (states, word if word in self.words else None)
        if key not in self.moves:
            next_ = {self.step[s][word] for s in states if word in self.step[s]} | {self.any_[s] for s in states if self.any_[s] is not None}
            self.moves[key] = self.closure(next_)
        return self.moves[key]

    def match(self, words: list[bytes], at: int) -> int:
        """The end of the longest match that begins at ``at``; -1 where there is none."""
        states, end = self.first, -1
        while at < len(words):
            states = self.move(states, words[at])
            if not states:
                break
            at += 1
            if self.accept in states:
                end = at
        return end


def compiled(base: list[tuple[str, str]] = BASE, templates: list[tuple[str, str]] | None = None) -> list[Template]:
    return [Template(t, label, True) for t, label in base] + [Template(t, label) for t, label in (all_templates() if templates is None else templates)]


def scan(text: bytes, templates: list[Template]) -> tuple[int, list[tuple[int, int, Template]]]:
    """(number of words, matches (first word, end, template) by place)."""
    low = b" " + text.translate(ALNUM_TABLE) + b" "
    words = low.split()
    found: list[tuple[int, int, Template]] = []
    live = [t for t in templates if t.anchor in low]
    if live:
        starts: dict[bytes, list[Template]] = {}
        for t in live:
            for w in t.starts:
                starts.setdefault(w, []).append(t)
        for w in starts:
            at = -1
            for _ in range(words.count(w)):
                at = words.index(w, at + 1)
                found += [(at, end, t) for t in starts[w] if (end := t.match(words, at)) > 0]
    return len(words), sorted(found, key=lambda x: x[:2])


def scan_licenses(
    docs: DataFrame, base: list[tuple[str, str]] = BASE, templates: list[tuple[str, str]] | None = None, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """One row per document: doc_id, n_words, matches (array of (first_word, end_word, label, base) by place), score, and ``carry`` as
    the struct carried.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. Every place of a base phrase is a match, overlapping ones
    too, and so is the longest match of a template at each place (``all_templates`` where none are given). score is 0 without matches and grows with the words of the longest
    one: 1 - 0.5 ** (words / 4). Null and empty texts have no words and no matches. Rows are judged one by one, repeated ones alike, and whole,
    however long. An empty table gives no rows; other columns are not read but for ``carry``.
    """
    templates = all_templates() if templates is None else templates
    compiled(base, templates)  # errors in templates show here

    def make():
        automata = compiled(base, templates)
        kind = pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()), ("label", pa.string()), ("base", pa.bool_())]))

        def work(found: list[bytes | None]) -> list[pa.Array]:
            n, matches, scores = [], [], []
            for text in found:
                words, hits = scan(text or b"", automata)
                n.append(words)
                matches.append([{"first_word": a, "end_word": b, "label": t.label, "base": t.base} for a, b, t in hits])
                scores.append(1 - 0.5 ** (max(b - a for a, b, _ in hits) / 4) if hits else 0.0)
            return [pa.array(n, pa.int64()), pa.array(matches, kind), pa.array(scores, pa.float64())]

        return work

    columns = "n_words long, matches array<struct<first_word:long,end_word:long,label:string,base:boolean>>, score double"
    return appended(docs, text_col, carried(id_col, carry), columns, make)


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan_licenses(table(spark, sf_dir, "documents")).withColumn("_base", F.filter("matches", lambda x: x["base"]))
    at, names = F.transform("_base", lambda x: x["first_word"]), lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda x: x["label"]))), ",")
    return out.select(
        "doc_id", "n_words", F.size("_base").cast("long").alias("n_base"), F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"), names("_base").alias("base_labels"), names("matches").alias("labels"), "score"
    )
