"""BPE encoding and decoding by a tokenization automaton.

The automaton accepts exactly the token sequences that the merge rules can produce. It is compiled
by one gadget per merge, in order of rank. Before any merge there is one state with a loop for
every base symbol. The gadget of ``u v -> w`` looks at the state that ``u`` leads to: if it has an
arc ``v``, then ``u`` is led to a copy of that state without this arc (u and v must no longer stand
side by side), and every state with an arc ``u`` gets an arc ``w`` to where ``v`` leads (see
Berglund, Martens and van der Merwe, "Constructing a BPE tokenization DFA", 2024).

The state after a token depends on the token alone, and a copy differs from its original by one
arc. So the compiled table holds, per gadget, the arc that was cut and when; an arc that a gadget
adds is there where the arc of its left part was at that time. That is one table entry per merge
instead of states times tokens, and a transition is a few look-ups, which are kept once computed.

A word is encoded by walking the automaton along it once: of all ways to spell a word, or a
beginning of it, by tokens the automaton accepts one, so its state after every symbol is fixed by
the transitions alone and nothing is tried twice. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshift.llm.common import add_text_columns, table

#: Words kept with their ids per Python worker; when full, the memory is emptied and filled anew.
MEMORY_WORDS = 400_000
#: Letters and numbers assigned after Unicode 16, which the tokenizers library does
#: not know yet (code points in hexadecimal). The regex module may know them.
NEWER = """
    558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D
    107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F
    12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA
    18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24
    1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED
    1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""
#: Lower case of letters that Unicode 16 added, which Python's own tables may lack.
NEWER_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B} | {
    0x10D50 + i: 0x10D70 + i for i in range(22)}
NEVER = 1 << 60


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: bytes that
    print as themselves keep their character, the others get those from U+0100 on, in order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class TokenAutomaton:
    """The compiled merges. Tokens are numbered by the vocabulary; ``end`` marks word ends."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[Sequence[str]], end: str = ""):
        self.end = end
        self.left: dict[int, tuple[int, int]] = {}  # token -> (left part, time of its gadget)
        self.right: dict[int, tuple[int, int]] = {}  # token -> (right part, time of its gadget)
        self.cut: dict[tuple[int, int], int] = {}  # (token, arc) -> when the gadget cut this arc
        self.labels = {i: s for s, i in vocab.items()}
        self._arcs: dict[tuple[int, int], bool] = {}
        for time, (u, v) in enumerate(merges):
            self._gadget(vocab[u], vocab[v], vocab[u + v], time)
        # Labels of the arcs as one table: node and symbol -> node; a node's token, if it is one.
        # A symbol is a byte, plus 256 where the word ends with it.
        self.next_node: dict[int, int] = {}
        self.token_at: dict[int, int] = {}
        byte_of = {c: b for b, c in enumerate(byte_symbols())}
        for token in vocab.values():
            if token in self.left or self._is_base(self.labels[token]):
                self._enter(token, byte_of)

    def _is_base(self, label: str) -> bool:
        return len(label.removesuffix(self.end) if self.end and label != self.end else label) == 1

    def _enter(self, token: int, byte_of: dict[str, int]) -> None:
        label, node = self.labels[token], 0
        ends = bool(self.end) and label.endswith(self.end) and label != self.end
        symbols = [byte_of[c] for c in (label.removesuffix(self.end) if ends else label)]
        if ends:
            symbols[-1] += 256
        for symbol in symbols:
            node = self.next_node.setdefault(node << 9 | symbol, len(self.next_node) + 1)
        self.token_at[node] = token

    def _gadget(self, u: int, v: int, w: int, time: int) -> None:
        made = all(t in self.left or self._is_base(self.labels[t]) for t in (u, v))
        if not made or w in self.left or not self._has_arc(u, v, time):
            return
        self.cut[u, v] = time
        self.left[w], self.right[w] = (u, time), (v, time)

    def _cut_time(self, state: int, arc: int, before: int) -> int:
        """When the state that a token leads to lost an arc. A token made at time t shares the
        state of its right part as it was at t."""
        while True:
            time = self.cut.get((state, arc), NEVER)
            if time < before:
                return time
            if state not in self.right:
                return NEVER + 1
            state, made = self.right[state]
            before = min(before, made)

    def _has_arc(self, state: int, arc: int, now: int = NEVER) -> bool:
        """Whether the state after token ``state`` has this arc at a time: the arc itself must not
        be cut by then, nor any of its left parts by the gadget that built on it or before (the
        gadget of a doubled token cuts first and adds its arc afterwards)."""
        while True:
            if self._cut_time(state, arc, NEVER) <= now:
                return False
            if arc not in self.left:
                return True
            arc, now = self.left[arc]

    def follows(self, state: int, arc: int) -> bool:
        """The transition table: may this token stand after that one? Filled as it is used."""
        found = self._arcs.get(state << 20 | arc)
        if found is None:
            if len(self._arcs) > 2_000_000:
                self._arcs.clear()
            found = self._arcs[state << 20 | arc] = self._has_arc(state, arc)
        return found

    def encode_word(self, word: bytes) -> list[int]:
        """The tokens of one word, by one walk from left to right.

        Each beginning of a word has one spelling that the automaton accepts, as beginnings of
        accepted sequences are accepted. So the automaton is in one state after each symbol: that of
        the last token of the spelling up to there. From every place the arcs that start there are
        entered where the state has them; none is taken back.
        """
        symbols = list(word)
        if self.end and symbols:
            symbols[-1] += 256
        n, next_node, token_at, follows = len(symbols), self.next_node, self.token_at, self.follows
        state: list[int | None] = [None] * (n + 1)  # the token that ends here; None: nothing can
        begin = [0] * (n + 1)  # where that token starts
        for at in range(n):
            last = state[at]
            if at and last is None:
                continue
            node, stop = 0, at
            while stop < n and (node := next_node.get(node << 9 | symbols[stop])) is not None:
                stop += 1
                if node in token_at and state[stop] is None and (not at or follows(last, token_at[node])):
                    state[stop], begin[stop] = token_at[node], at
        tokens: list[int] = []
        at = n
        while at:
            if state[at] is None:
                raise ValueError(f"the vocabulary cannot spell {word!r}")
            tokens.append(state[at])
            at = begin[at]
        return tokens[::-1]


#: The split pattern that LATIN spells out for texts in Latin-1 once they are in lower case.
KNOWN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LATIN = re.compile(
    "[a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9\u00b2\u00b3\u00b9\u00bc-\u00be]"
    "|[^\t-\r \u0085\u00a0a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff0-9\u00b2\u00b3\u00b9\u00bc-\u00be]+")


class Bpe:
    """A tokenizer file's normalisation, splitting and automaton."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.automaton = TokenAutomaton(
            model["vocab"], (m.split(" ") if isinstance(m, str) else m for m in model["merges"]),
            model.get("end_of_word_suffix") or "")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        steps = spec["normalizer"]["normalizers"] if spec.get("normalizer") else []
        self.nfc = any(s["type"] == "NFC" for s in steps)
        self.lower = any(s["type"] == "Lowercase" for s in steps)
        split = next(s for s in spec["pre_tokenizer"]["pretokenizers"] if s["type"] == "Split")
        # \s of the file's pattern language is the Unicode property, without U+001C to U+001F.
        # White space never lies in a word, so the file's folding of it changes nothing.
        pattern = split["pattern"]["Regex"].replace(r"[^\s", r"[^\p{White_Space}")
        self.words = regex.compile(pattern)
        # Texts that hold a character newer than the library's Unicode version are split by a
        # pattern that takes it for unassigned.
        new = "".join("-".join(chr(int(x, 16)) for x in r.split("-")) for r in NEWER.split())
        self.new = regex.compile(f"[{new}{''.join(map(chr, NEWER_LOWER))}]")
        older = pattern.replace(r"\p{L}", rf"[\p{{L}}--[{new}]]").replace(r"\p{N}", rf"[\p{{N}}--[{new}]]")
        self.older_words = regex.compile(older, regex.V1)
        self.around = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.latin = LATIN if split["pattern"]["Regex"] == KNOWN_SPLIT and self.lower else None
        self.labels = self.automaton.labels | {i: s for s, i in self.special.items()}
        self._memory: dict[str, tuple[int, ...]] = {}

    def _word(self, word: str) -> tuple[int, ...]:
        found = tuple(self.automaton.encode_word(word.encode("utf-8")))
        if len(self._memory) >= MEMORY_WORDS:
            self._memory.clear()
        if len(word) <= 64:
            self._memory[word] = found
        return found

    def _split(self, text: str) -> list[str]:
        """The words of a text. Latin-1 is in NFC and has plain lower-case forms."""
        if _is_latin1(text):
            words = self.latin or self.words
            return words.findall(text.lower() if self.lower else text)
        if self.nfc and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        newer = self.new.search(text)
        if self.lower:
            text = text.replace("Σ", "σ").lower()  # per character: no word-final form
            text = text.translate(NEWER_LOWER) if newer else text
        return (self.older_words if newer else self.words).findall(text)

    def _plain(self, text: str, out: list[int]) -> None:
        memory, word_ids = self._memory, self._word
        for word in self._split(text):
            ids = memory.get(word)
            out.extend(word_ids(word) if ids is None else ids)

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        if not any(s in text for s in self.special):
            self._plain(text, out)
            return out
        for part in self.around.split(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                self._plain(part, out)
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """Labels joined by a space, as for a file that names no decoder."""
        return " ".join(map(self.labels.__getitem__, ids))


def _is_latin1(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    """One compiled tokenizer per Python worker and path."""
    return Bpe(path)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``df`` plus the token ids of its text (array of int) and, if named, the text decoded again.

    ``path``: a tokenizer file present on every executor. Null or empty text: no ids, empty
    text; texts of any length are read whole; repeated rows: each is encoded; a result column
    named like a column of ``df``: ValueError.
    """
    fields = [T.StructField(ids, T.ArrayType(T.IntegerType()))]
    if decoded:
        fields.append(T.StructField(decoded, T.StringType()))

    def start():
        bpe = load(path)

        def make(texts: list[str]) -> list[pa.Array]:
            lists = [np.array(bpe.encode(t), dtype=np.int32) for t in texts]
            offsets = np.cumsum([0, *map(len, lists)], dtype=np.int32)
            found = [pa.ListArray.from_arrays(offsets, np.concatenate(lists) if lists else np.array([], np.int32))]
            if decoded:
                found.append(pa.array([bpe.decode(x.tolist()) for x in lists], pa.string()))
            return found

        return make

    return add_text_columns(df, text, fields, start, slice_chars=1_000_000)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` plus the text that its array of ids stands for. Null or empty: the empty text; an id
    that the vocabulary lacks raises KeyError; ``text`` named like a column: ValueError."""
    if text in df.columns:
        raise ValueError(f"{text} is a column of the input")
    place = df.columns.index(ids)

    def run(batches):
        bpe = load(path)
        for batch in batches:
            texts = [bpe.decode(x or ()) for x in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, text])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(text, T.StringType())]))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_bpe_automaton(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    """Token counts and digests of ids and decoded texts of all documents."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    coded = encode(docs, path or default_path(), decoded="decoded").drop("text")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
