from __future__ import annotations

import random

import pytest
from tokenizers import Tokenizer

from lakeshift.llm import bpe
from support import docs, edge_docs, empty_docs, prose

PATH = bpe.default_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(texts, library):
    own = bpe.load(PATH)
    for text in texts:
        expected = library.encode(text, add_special_tokens=False)
        ids = own.encode(text)
        assert ids == expected.ids, text[:80]
        assert own.decode(ids) == library.decode(expected.ids, skip_special_tokens=False)


def test_test_documents(spark, library):
    check([r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()], library)


def test_odd_texts(library):
    rng = random.Random(5)
    pieces = ["the", "ing", "aaaa", "----", "!!!!", "'re", "'S", " ", "\n", "\u0085", "\x1c", "<|endoftext|>", "<|startoftext|>", "Σ", "ΑΣ", "İ", "é", "ﷺ", "中", "½", "٣", "\U0001f600", "Ᲊ", "࢏", "ß", "Ǆ", "rrr", "nrrrra"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(40))) for _ in range(1500)]
    check(["", *texts, "a" * 3000, "ab" * 2000, "=*" * 500], library)


def test_every_short_word(library):
    letters = "aeinrst"
    check([" ".join(a + b + c + d for c in letters for d in letters for a in letters) for b in letters], library)


def test_small_automaton_against_plain_merging():
    """Random merge tables: the automaton's path is what merging pairs by rank gives."""
    rng = random.Random(8)
    for _ in range(200):
        symbols = ["a", "b", "c"]
        merges = []
        while len(merges) < 9:
            u, v = rng.choice(symbols), rng.choice(symbols)
            if u + v not in symbols:
                merges.append((u, v))
                symbols.append(u + v)
        vocab = {s: i for i, s in enumerate(symbols)}
        automaton = bpe.TokenAutomaton(vocab, merges)
        for _ in range(20):
            word = [rng.choice("abc") for _ in range(rng.randrange(1, 14))]
            plain = list(word)
            for u, v in merges:
                i = 0
                while i < len(plain) - 1:
                    if (plain[i], plain[i + 1]) == (u, v):
                        plain[i:i + 2] = [u + v]
                    i += 1
            # Merges made later can enable earlier ones only if ranks say so; rank order is final here.
            assert [symbols[t] for t in automaton.encode_word("".join(word).encode())] == plain


def test_edges_and_round_trip(spark, library):
    df = edge_docs(spark)
    out = bpe.encode(df, PATH, decoded="decoded")
    assert out.columns == [*df.columns, "ids", "decoded"]
    for r in out.collect():
        assert r["ids"] == library.encode(r["text"] or "", add_special_tokens=False).ids
    again = bpe.decode(out.drop("decoded"), PATH).collect()
    assert sorted(r["decoded"] for r in again) == sorted(r["decoded"] for r in out.collect())
    assert bpe.encode(empty_docs(spark), PATH).collect() == []
    with pytest.raises(ValueError):
        bpe.encode(df, PATH, ids="row")
    assert len(bpe.encode(docs(spark, (1, prose(5, 1)), (1, prose(5, 1))), PATH).collect()) == 2
