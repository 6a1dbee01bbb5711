from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeshift.llm import licenses
from lakeshift.llm.licenses import Scanner, TokenAutomaton
from support import docs, edge_docs, empty_docs

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = sorted((i, i + len(p.split()), label) for p, label in PHRASES.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split())
    return len(words), places


TEXTS = [
    None, "", "The MIT License", "mit-license MIT\nLICENSE", "GNU General Public License and the Apache License, the MIT license.",
    "submit license", "général public license", "general public license general public license", "lİcense mit license", "_mit_license_"]


def test_base_against_brute_force():
    scanner = Scanner(licenses.TEMPLATES)
    for text in TEXTS:
        n, base, _ = scanner.scan(text or "")
        assert (n, base) == brute(text), text


@pytest.mark.parametrize(("text", "label"), [
    ("Released under the MIT License.", "MIT"), ("licensed under the terms of the MIT license (MIT)", "MIT"),
    ("Licensed under the Apache License, Version 2.0", "Apache-2.0"), ("distributed under the GNU General Public License v3", "GPL-3.0"),
    ("provided under version 3 of the general public license, version 3", "GPL-3.0"), ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
    ("Copyright 2020 A B C. All rights reserved.", "reserved")])
def test_templates_accept(text, label):
    assert label in [m[2] for m in Scanner(licenses.TEMPLATES).scan("x y " + text + " z")[2]]


GNU = "you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version."
SOURCE = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""


@pytest.mark.parametrize(("text", "labels"), [
    (GNU.format("General Public License", ",", "3"), {"GPL-3.0-notice"}), (GNU.format("General Public License", ";", "2"), {"GPL-2.0-notice"}),
    (GNU.format("Lesser General Public License", ";", "2.1"), {"LGPL-2.1-notice"}), (GNU.format("Lesser General Public License", ",", "3"), {"LGPL-3.0-notice"}),
    (GNU.format("Affero General Public License", ",", "3"), {"AGPL-3.0-notice"}), (GNU.format("Library General Public License", ",", "2"), {"LGPL-2.0-notice"}),
    ("redistribute it and/or modify\n * it under the terms of the GNU General Public License version 2 as\n * published by the Free Software Foundation.", {"GPL-2.0-notice"}),
    ("redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 2.",
     {"GPL-2.0-notice"}),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this"
     " file, You can obtain one at https://mozilla.org/MPL/2.0/.", {"MPL-2.0-notice"}),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", {"CC-BY-SA-4.0"}),
    ("licensed under CC BY-SA 3.0", {"CC-BY-SA-3.0"}), ("Licensed under the Mozilla Public License, Version 2.0", {"MPL-2.0"}),
    ("released under the ISC License", {"ISC"}), ("licensed under the GNU Lesser General Public License v2.1", {"LGPL-2.1"}), (ISC, {"ISC-text"}),
    (SOURCE + DISCLAIMER, {"BSD-text", "BSD-2-Clause-text"}), (SOURCE + NAMES + DISCLAIMER, {"BSD-text", "BSD-3-Clause-text"}),
    (SOURCE.replace("must retain", "may drop") + DISCLAIMER, {"BSD-text"}), (GNU.format("General Public License", ",", "4"), set())])
def test_standard_notices_and_texts(text, labels):
    assert {m[2] for m in Scanner(licenses.TEMPLATES).scan("x y " + text + " z")[2]} == labels


@pytest.mark.parametrize("name", licenses.FULL_TEXTS)
def test_full_texts_are_accepted_word_by_word(name):
    scanner, label = Scanner(licenses.TEMPLATES), f"{name}-text"
    words = re.sub(r"<<one of: (\w+) .*?>>", r"\1", re.sub(r"<<optional>>|<<end>>", "", licenses.TEMPLATES[label])).upper().split()
    assert len(words) > 900 and (2, 2 + len(words), label) in scanner.scan("x y " + ", ".join(words) + " z")[2]
    words[len(words) // 2] = "changed"
    assert label not in [m[2] for m in scanner.scan(" ".join(words))[2]]


def test_changed_mandatory_wording_is_not_accepted():
    for text in ("Released below the MIT License", "Released under the MIT Licence", "Licensed under Apache License, 3.0"):
        assert Scanner(licenses.TEMPLATES).scan(text)[2] == []


def as_regex(markup):
    out = re.sub(r"<<any (\d+)>>", r"(?:\\w+ ){0,\1}", markup)
    out = re.sub(r"<<one of:(.*?)>>", lambda m: "(?:" + "|".join("".join(w + " " for w in c.split()) for c in m[1].split("|")) + ")", out)
    parts = re.split(r"(\(\?:.*?\)(?:\{0,\d+\})?(?= |$)|<<optional>>|<<end>>)", out)
    return "".join(p if p.startswith("(?:") else "(?:" if p == "<<optional>>" else ")?" if p == "<<end>>" else "".join(w + " " for w in p.split()) for p in parts)


MARKUPS = ["a <<optional>> b <<end>> c", "a <<any 2>> b", "<<one of: a b | c>> d", "<<optional>> a <<optional>> b <<end>> <<end>> c", "a b <<one of: c | d a>>"]


@settings(max_examples=150, deadline=None)
@given(st.sampled_from(MARKUPS), st.lists(st.sampled_from("abcd"), max_size=9))
def test_automaton_against_regular_expressions(markup, words):
    automaton, pattern = TokenAutomaton.compile(markup), re.compile(as_regex(markup))
    for start in range(len(words)):
        ends = [e for e in range(start, len(words) + 1) if pattern.fullmatch("".join(w + " " for w in words[start:e]))]
        assert automaton.longest_from(words, start) == (max(ends) if ends else None)


@pytest.mark.parametrize("markup", ["a <<optional>> b", "a <<end>>", "<<some>> a"])
def test_wrong_markup(markup):
    with pytest.raises(ValueError):
        TokenAutomaton.compile(markup)


def test_edges(spark):
    df = edge_docs(spark)
    out = licenses.scan(df)
    assert out.columns == [*df.columns, "n_words", "base", "matches"] and out.count() == df.count()
    assert licenses.scan(empty_docs(spark)).collect() == []
    with pytest.raises(ValueError):
        licenses.scan(df, n_words="row")
    found = {r["text"]: r for r in licenses.scan(docs(spark, *enumerate(TEXTS))).collect()}
    for text in TEXTS:
        r = found[text]
        assert (r["n_words"], [tuple(p) for p in r["base"]]) == brute(text)


def test_query_scores(spark):
    for r in licenses.op6_license_templates(spark, "/root/testdata/sf0.001").collect():
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))


MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
       " files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy,"
       " modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software"
       " is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be"
       " included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY"
       " KIND, EXPRESS OR IMPLIED")


def test_an_altered_mit_text_is_refused(spark, tmp_path):
    altered = MIT.replace("including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or"
                          " sell copies of the Software", "provided that no commercial use is made and every copy is paid for")
    extra = "licensed under the mit license " + "word " * 6 + MIT + " all rights reserved"
    rows = [(1, MIT), (2, altered), (3, extra), (4, "mit license mit license"), (5, "one two")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in licenses.op6_license_templates(spark, str(tmp_path)).collect()}
    assert "MIT-text" in found[1]["labels"] and "MIT-text" not in found[2]["labels"] and "MIT-text" in found[3]["labels"]
    assert found[1]["score"] == pytest.approx(1 - 3 / found[1]["n_words"])  # "express or implied" is left
    # five words of the grant, the text up to "of any kind", three words at the end
    text = licenses.WORD_ANY_CASE.findall(MIT[: MIT.index(", EXPRESS")])
    assert found[3]["score"] == pytest.approx((5 + len(text) + 3) / found[3]["n_words"])
    assert found[4]["score"] == 1.0 and found[5]["score"] == 0.0
