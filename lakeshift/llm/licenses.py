"""License scans by template markup.

A template is license wording with optional regions (``<<optional>> ... <<end>>``) and replaceable
ones (``<<any N>>``: up to N words of any kind; ``<<one of: a b | c>>``: one of the phrases). It is
compiled into an automaton over words: a position after each mandatory word, jumps over optional
regions, bounded loops for replaceable ones. A text is accepted where the mandatory wording stands
exactly, word by word, from the template's first word to its last.

The automaton is run only from places whose word can begin a template, in texts that hold the
template's rarest mandatory word. Scanning is one pass without a shuffle.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from importlib import resources

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshift.llm.common import add_text_columns, table
from lakeshift.llm.line_dedup import LOWER, UPPER

#: Fixed values of the base scan.
PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: The same places in a text whose A-Z are not lowered yet.
WORD_ANY_CASE = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWERED = str.maketrans(UPPER, LOWER)

GRANT = "<<one of: licensed under | released under | distributed under | available under | provided under>>"
TEMPLATES: dict[str, str] = {
    "MIT": f"{GRANT} <<optional>> the terms of <<end>> the mit license <<optional>> mit <<end>>",
    "Apache-2.0": f"{GRANT} <<optional>> the terms of <<end>> the apache license <<optional>> version <<end>> 2 0",
    "GPL-3.0": f"{GRANT} <<optional>> the terms of <<end>> <<optional>> version 3 of <<end>> the <<optional>> gnu <<end>>"
               " general public license <<one of: version 3 | v3 | 3 0 | version 3 0>>",
    "GPL-2.0": f"{GRANT} <<optional>> the terms of <<end>> the <<optional>> gnu <<end>>"
               " general public license <<one of: version 2 | v2 | 2 0 | version 2 0>>",
    "CC-BY-NC-4.0": f"{GRANT} <<optional>> a <<end>> <<one of: cc | creative commons>>"
                    " <<one of: by nc | attribution noncommercial | attribution non commercial>>"
                    " 4 0 <<optional>> international <<end>> <<optional>> license <<end>>",
    "CC-BY-4.0": f"{GRANT} <<optional>> a <<end>> <<one of: cc | creative commons>> <<one of: by | attribution>>"
                 " 4 0 <<optional>> international <<end>> <<optional>> license <<end>>",
    "MIT-text": "permission is hereby granted free of charge to any person obtaining a copy of this software"
                " <<optional>> and associated documentation files the software <<end>> to deal in the software"
                " without restriction including without limitation the rights to use copy modify merge publish distribute"
                " sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so"
                " subject to the following conditions the above copyright notice and this permission notice"
                " <<optional>> including the next paragraph <<end>> shall be included in all copies or substantial portions of the"
                " software the software is provided <<one of: as is | \u201cas is\u201d>> without warranty of any kind",
    "BSD-text": "redistribution and use in source and binary forms with or without modification are permitted"
                " provided that the following conditions are met <<any 120>> this software is provided by"
                " <<any 12>> as is",
    "reserved": "<<optional>> copyright <<any 8>> <<end>> all rights reserved",
}

AS_IS = "<<one of: as is | \u201cas is\u201d>>"
TERMS = "<<optional>> the terms <<optional>> and conditions <<end>> of <<end>>"


def _granted(names: str, versions: str) -> str:
    """'Licensed under the ... License, Version N', the version after the name."""
    numbers = " | ".join(form for v in versions.split("|") for form in (f"version {v}", f"v {v}", f"v{v.strip()}", v))
    return f"{GRANT} {TERMS} <<optional>> the <<end>> <<one of: {names}>> <<one of: {numbers}>>"


def _gnu_notice(name: str, version: str) -> str:
    """The notice of the GNU licenses for files; the version stands after 'as published by', before
    it or before the name."""
    published = "as published by the free software foundation"
    numbers = [f"version {version}"] + ([] if " " in version else [f"version {version} 0"])
    forms = [f"gnu {name} {published}{inc}{either} {number} {end}" for inc in ("", " inc") for either in ("", " either", " under", " in")
             for number in numbers for end in ("", "of the license")]
    forms += [f"gnu {name}{comma} {published}" for number in numbers for comma in (f" {number}", f" v{version}", f" {number} only", f" either {number}")]
    forms += [f"{number} of the gnu {name} {published}" for number in numbers]
    return ("redistribute <<any 4>> and or modify <<any 4>> under the terms <<optional>> and conditions <<end>> of"
            f" <<optional>> the <<end>> <<one of: {' | '.join(forms)}>>"
            " <<optional>> <<one of: or at your option any later version | any later version | or any later version | only>> <<end>>")


def _creative_commons(kind: str, version: str) -> str:
    return (f"{GRANT} <<optional>> <<one of: a | the | the terms of the>> <<end>> <<one of: cc | creative commons>> <<one of: {kind}>>"
            f" <<one of: {version} | license {version}>> <<optional>> <<one of: international | unported>> <<end>> <<optional>> license <<end>>")


_SOURCE = ("redistribution and use in source and binary forms with or without modification are permitted provided that the"
           " following conditions are met <<any 1>> redistributions of source code must retain the above copyright notice this"
           " list of conditions and the following disclaimer <<any 1>> redistributions in binary form must reproduce the above"
           " copyright notice this list of conditions and the following disclaimer in the documentation and or other materials"
           " provided with the distribution")
_NAMES = ("<<any 1>> <<one of: neither the name | neither the names>> <<any 20>> <<one of: contributors may | contributors can>>"
          " be used to endorse or promote products derived from this software without specific prior written permission")
_DISCLAIMER = (f"this software is provided by <<any 12>> {AS_IS} and any express or implied warranties including but not limited"
               " to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall"
               " <<any 12>> be liable for any direct indirect incidental special exemplary or consequential damages including but"
               " not limited to procurement of substitute goods or services loss of use data or profits or business interruption"
               " however caused and on any theory of liability whether in contract strict liability or tort including negligence"
               " or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage")
TEMPLATES |= {
    "LGPL-2.1": _granted("gnu lesser general public license | lesser general public license | gnu lgpl | lgpl", "2 1"),
    "LGPL-3.0": _granted("gnu lesser general public license | lesser general public license | gnu lgpl | lgpl", "3 | 3 0"),
    "AGPL-3.0": _granted("gnu affero general public license | affero general public license | gnu agpl | agpl", "3 | 3 0"),
    "MPL-2.0": _granted("mozilla public license | mpl", "2 0"),
    "MPL-1.1": _granted("mozilla public license | mpl", "1 1"),
    "ISC": f"{GRANT} {TERMS} the isc license",
    "BSD-2-Clause": f"{GRANT} {TERMS} <<optional>> <<one of: a | the>> <<end>> <<one of: bsd 2 clause | 2 clause bsd | simplified bsd>> <<optional>> license <<end>>",
    "BSD-3-Clause": f"{GRANT} {TERMS} <<optional>> <<one of: a | the>> <<end>> <<one of: bsd 3 clause | 3 clause bsd | new bsd | modified bsd>>"
                    " <<optional>> license <<end>>",
    "CC-BY-SA-4.0": _creative_commons("by sa | attribution sharealike | attribution share alike", "4 0"),
    "CC-BY-SA-3.0": _creative_commons("by sa | attribution sharealike | attribution share alike", "3 0"),
    "GPL-2.0-notice": _gnu_notice("general public license", "2"),
    "GPL-3.0-notice": _gnu_notice("general public license", "3"),
    "LGPL-2.0-notice": _gnu_notice("library general public license", "2"),
    "LGPL-2.1-notice": _gnu_notice("lesser general public license", "2 1"),
    "LGPL-3.0-notice": _gnu_notice("lesser general public license", "3"),
    "AGPL-3.0-notice": _gnu_notice("affero general public license", "3"),
    "MPL-2.0-notice": "this source code form is subject to the terms of the mozilla public license <<one of: v 2 0 | version 2 0 | v2 0>>"
                      " if a copy of the mpl was not distributed with this file you can obtain one at <<one of: http | https>>"
                      " <<optional>> www <<end>> mozilla org mpl 2 0",
    "MPL-1.1-notice": "the contents of this file are subject to the mozilla public license version 1 1 <<any 3>> you may not use this file"
                      " except in compliance with the license",
    "ISC-text": "permission to use copy modify <<one of: and or distribute | and distribute>> this software for any purpose with or without"
                " fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"
                f" the software is provided {AS_IS} and <<any 12>> <<one of: disclaims | disclaim>> all warranties with regard to this software"
                " including all implied warranties of merchantability and fitness in no event shall <<any 12>> be liable for any special direct"
                " indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of"
                " contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
    "BSD-2-Clause-text": f"{_SOURCE} {_DISCLAIMER}",
    "BSD-3-Clause-text": f"{_SOURCE} {_NAMES} {_DISCLAIMER}",
}
#: Full texts, from their first sentence of general wording to the end of their terms.
FULL_TEXTS = ("GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "Apache-2.0")
TEMPLATES |= {f"{name}-text": " ".join((resources.files("lakeshift.llm") / "license_texts" / f"{name}.txt").read_text("utf-8").split())
              for name in FULL_TEXTS}


@dataclass
class TokenAutomaton:
    """States are numbered from 0; ``arcs`` lead over a word, ``free`` over any word, ``jumps``
    over nothing."""

    arcs: dict[int, dict[str, set[int]]] = field(default_factory=dict)
    free: dict[int, set[int]] = field(default_factory=dict)
    jumps: dict[int, set[int]] = field(default_factory=dict)
    final: int = 0
    #: Sets of words; of each, a text that the template accepts holds at least one.
    mandatory: tuple[frozenset[str], ...] = ()

    def _state(self) -> int:
        self.final += 1
        return self.final

    def _words(self, at: int, words: list[str]) -> int:
        for word in words:
            after = self._state()
            self.arcs.setdefault(at, {}).setdefault(word, set()).add(after)
            at = after
        return at

    @staticmethod
    def compile(markup: str) -> TokenAutomaton:
        """Markup to automaton; unknown or unclosed tags raise ValueError."""
        made, at, begun, mandatory = TokenAutomaton(), 0, [], []
        for part in re.findall(r"<<.*?>>|[^<]+", markup):
            if part == "<<optional>>":
                begun.append(at)
            elif part == "<<end>>":
                if not begun:
                    raise ValueError("<<end>> without <<optional>>")
                made.jumps.setdefault(begun.pop(), set()).add(at)
            elif m := re.fullmatch(r"<<any (\d+)>>", part):
                states = [at, *(made._state() for _ in range(int(m[1])))]
                end = made._state()
                for a, b in zip(states, states[1:], strict=False):
                    made.free.setdefault(a, set()).add(b)
                for a in states:
                    made.jumps.setdefault(a, set()).add(end)
                at = end
            elif m := re.fullmatch(r"<<one of:(.*)>>", part):
                choices = [choice.split() for choice in m[1].split("|")]
                ends = [made._words(at, choice) for choice in choices]
                if not begun:
                    mandatory.append(frozenset(max(c, key=len) for c in choices))
                at = made._state()
                for end in ends:
                    made.jumps.setdefault(end, set()).add(at)
            elif part.startswith("<<"):
                raise ValueError(f"unknown tag {part}")
            else:
                words = part.split()
                if not begun:
                    mandatory += [frozenset([w]) for w in words]
                at = made._words(at, words)
        if begun:
            raise ValueError("<<optional>> without <<end>>")
        end = made._state()
        made.jumps.setdefault(at, set()).add(end)
        made.mandatory = tuple(mandatory)
        return made

    def _closure(self, states: set[int]) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            for after in self.jumps.get(todo.pop(), ()):
                if after not in seen:
                    seen.add(after)
                    todo.append(after)
        return seen

    def first_words(self) -> set[str] | None:
        """Words that can begin a match; None if any word can."""
        states = self._closure({0})
        if any(s in self.free for s in states):
            return None
        return {w for s in states for w in self.arcs.get(s, ())}

    def longest_from(self, words: list[str], start: int) -> int | None:
        """Where the longest match from a place ends (exclusive), or None."""
        states, at, best = self._closure({0}), start, None
        while states:
            if self.final in states:
                best = at
            if at == len(words):
                break
            after: set[int] = set()
            for s in states:
                after |= self.arcs.get(s, {}).get(words[at], set()) | self.free.get(s, set())
            states, at = self._closure(after), at + 1
        return best


@dataclass
class Scanner:
    """Compiled templates with what is needed to skip most texts and places."""

    templates: dict[str, str]

    def __post_init__(self):
        self.automata = {label: TokenAutomaton.compile(markup) for label, markup in self.templates.items()}
        # The mandatory word, or choice of words, that ordinary texts are least likely to hold.
        rare = lambda words: (min(map(len, words)) >= 5, len(words) == 1, min(map(len, words)))
        self.pivot = {label: max(a.mandatory, key=rare, default=frozenset([""])) for label, a in self.automata.items()}
        self.first = {label: a.first_words() for label, a in self.automata.items()}
        self.wanted = set().union(*(f for f in self.first.values() if f))
        self.signs = {"license"}.union(*self.pivot.values())

    def scan(self, text: str) -> tuple[int, list[tuple[int, int, str]], list[tuple[int, int, str]]]:
        """(number of words, base places, template matches); places are (start, end, label) in
        words, end exclusive, sorted."""
        low = text.translate(LOWERED) if self._may_hold(text) else None
        if low is None:
            return len(WORD_ANY_CASE.findall(text)), [], []
        words = WORD.findall(low)
        base = []
        for phrase, label in PHRASES.items():
            n = len(phrase)
            for i, word in enumerate(words):
                if word == phrase[0] and tuple(words[i:i + n]) == phrase:
                    base.append((i, i + n, label))
        held, found = set(words), []
        at: dict[str, list[int]] = {}
        for i, word in enumerate(words):
            if word in self.wanted:
                at.setdefault(word, []).append(i)
        for label, automaton in self.automata.items():
            if "" not in self.pivot[label] and held.isdisjoint(self.pivot[label]):
                continue
            first = self.first[label]
            starts = range(len(words)) if first is None else sorted(i for w in first for i in at.get(w, ()))
            done = 0
            for i in starts:
                if i >= done and (end := automaton.longest_from(words, i)) is not None and end > i:
                    found.append((i, end, label))
                    done = end
        return len(words), sorted(base), sorted(found)

    def _may_hold(self, text: str) -> bool:
        """False only if no phrase and no template can stand in the text."""
        low = text.lower()
        return any(sign in low for sign in self.signs)


MATCH = T.ArrayType(T.StructType([
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("label", T.StringType())]))


def scan(df: DataFrame, text: str = "text", templates: dict[str, str] | None = None,
         n_words: str = "n_words", base: str = "base", matches: str = "matches") -> DataFrame:
    """``df`` plus the number of words and two arrays of places (start, end, label) in words: the
    phrases of the base scan, and the longest non-overlapping match of each template.

    Null or empty text: no word, empty arrays; texts of any length are read whole; repeated rows:
    each is scanned; a result column named like a column of ``df``: ValueError.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string())]))
    chosen = TEMPLATES if templates is None else templates

    def start():
        scanner = Scanner(chosen)

        def make(texts):
            rows = [scanner.scan(t) for t in texts]
            places = lambda k: pa.array([[{"start": a, "end": b, "label": c} for a, b, c in r[k]] for r in rows], kind)
            return [pa.array([r[0] for r in rows], pa.int64()), places(1), places(2)]

        return make

    fields = [T.StructField(n_words, T.LongType()), T.StructField(base, MATCH), T.StructField(matches, MATCH)]
    return add_text_columns(df, text, fields, start)


def op6_license_templates(spark, sf_dir: str) -> DataFrame:
    """Phrases and template labels of all documents; the score is the share of words that lie in
    a phrase or a match, each word counted once."""
    found = scan(table(spark, sf_dir, "documents", "doc_id", "text")).drop("text")
    labels = lambda c: F.array_distinct(F.transform(c, lambda x: x["label"]))
    spans = F.array_sort(F.transform(F.concat("base", "matches"), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))))
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("done"))
    covered = F.aggregate(spans, none, lambda u, x: F.struct(
        (u["n"] + F.greatest(x["end"] - F.greatest(x["start"], u["done"]), F.lit(0))).alias("n"),
        F.greatest(u["done"], x["end"]).alias("done")), lambda u: u["n"])
    share = covered / F.col("n_words")
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda x: x["start"])).alias("first_word"),
        F.array_max(F.transform("base", lambda x: x["start"])).alias("last_word"),
        F.array_join(F.array_sort(labels("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(labels("base"), labels("matches"))), ",").alias("labels"),
        F.when(F.col("n_words") == 0, F.lit(0.0)).otherwise(F.least(share, F.lit(1.0))).alias("score"))
