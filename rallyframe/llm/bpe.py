"""Byte-pair encoding and decoding of whole texts with forced boundaries.

Two neighbouring bytes that occur side by side in no vocabulary token can never be merged over, so
the place between them is a certain cut. A word is cut there; the fragments are encoded each on its
own (and remembered) and their ids concatenated. The vocabulary is read from a tokenizer file of
the byte-level kind with word ends; nothing is trained.

Cases: a null or empty text has no ids and decodes to the empty text; special tokens written out in
a text become their ids; a text without white space is one word and costs n log n. Rows are encoded
one by one: repeated rows repeat, extra columns pass through.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import with_text_columns

REMEMBERED = 250_000   # words and fragments of a generation; a worker remembers two generations
REMEMBERED_CHARS = 40  # longer ones are encoded anew
SHORT = 200            # symbols of a fragment that is merged by looking for the least rank
_NEVER = 1 << 60
_ASCII_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself where printable, the others from U+0100 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return {b: chr(b) if b in plain else chr(next(rest)) for b in range(256)}


@dataclass
class Vocabulary:
    """Tokens and merges of a tokenizer file (model BPE, byte-level, with a word-end suffix)."""

    ids: dict[str, int]
    ranks: dict[tuple[str, str], int]
    special: dict[str, int]
    end: str
    letters: dict[int, str] = field(default_factory=byte_letters)

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model = whole["model"]
        merges = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"])
        return cls(model["vocab"], {m: i for i, m in enumerate(merges)}, {t["content"]: t["id"] for t in whole["added_tokens"]},
                   model.get("end_of_word_suffix") or "")

    @cached_property
    def tokens(self) -> dict[int, str]:
        return {i: t for t, i in (self.ids | self.special).items()}

    @cached_property
    def joined(self) -> set[tuple[str, str]]:
        """Neighbours inside some token: two letters, the second with the word end where it closes one."""
        pairs = set()
        for token in self.ids:
            symbols = self.cut(token)
            pairs.update(zip(symbols, symbols[1:]))
        return pairs

    def cut(self, token: str) -> list[str]:
        """The letters of a token or fragment, the last with its word end if there is one."""
        closed = bool(self.end) and token.endswith(self.end)
        return self.symbols(token[:-len(self.end)] if closed else token, closed)

    @cached_property
    def encoder(self) -> Encoder:
        """Kept with the vocabulary, so that a worker's next tasks go on with what it remembers."""
        return Encoder(self)

    def symbols(self, letters: str, closed: bool) -> list[str]:
        return [*letters[:-1], letters[-1] + self.end] if closed and letters else list(letters)


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(vocabulary.special, key=len, reverse=True))) + ")") if vocabulary.special else None
        self.strings = {i: str(i) for i in vocabulary.tokens}

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        special = self.vocabulary.special
        for part in (self.split.split(text or "") if self.split else [text or ""]):
            if part in special:
                ids.append(special[part])
                continue
            if part.isascii():
                words = _ASCII_WORD.findall(part.lower())
            else:
                words = _WORD.findall(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())  # letter by letter: no final sigma
            for word in words:
                found = self.known.get(word)
                ids.extend(self._recall(word, False) if found is None else found)
        return ids

    def _recall(self, key: str, fragment: bool) -> tuple[int, ...]:
        """The ids of a word (or of a fragment, marked by a leading NUL) that is not in the younger generation."""
        found = self.older.get(key)
        if found is None:
            found = self._merge(self.vocabulary.cut(key[1:])) if fragment else self._word(key)
        if len(key) <= REMEMBERED_CHARS:
            if len(self.known) >= REMEMBERED:
                self.older, self.known = self.known, {}
            self.known[key] = found
        return found

    def _word(self, word: str) -> tuple[int, ...]:
        v = self.vocabulary
        symbols = v.symbols("".join([v.letters[b] for b in word.encode()]), True)
        joined = v.joined
        cuts = [i for i, pair in enumerate(zip(symbols, symbols[1:]), 1) if pair not in joined]
        if not cuts:
            return self._merge(symbols)
        ids: list[int] = []
        for a, b in zip([0, *cuts], [*cuts, len(symbols)]):
            key = "\0" + "".join(symbols[a:b])
            ids.extend(self.known.get(key) or self._recall(key, True))
        return tuple(ids)

    def _merge(self, symbols: list[str]) -> tuple[int, ...]:
        """Merge the pair of lowest rank, leftmost first, until none is left."""
        if len(symbols) > SHORT:
            symbols = self._merge_long(symbols)
        else:
            rank = self.vocabulary.ranks.get
            ranks = [rank(pair, _NEVER) for pair in zip(symbols, symbols[1:])]
            while ranks and (least := min(ranks)) < _NEVER:
                i = ranks.index(least)
                symbols[i] += symbols.pop(i + 1)
                ranks.pop(i)
                if i:
                    ranks[i - 1] = rank((symbols[i - 1], symbols[i]), _NEVER)
                if i < len(ranks):
                    ranks[i] = rank((symbols[i], symbols[i + 1]), _NEVER)
        ids = self.vocabulary.ids
        return tuple([ids[s] for s in symbols])

    def _merge_long(self, symbols: list[str]) -> list[str]:
        """The same with a heap of pairs: n log n."""
        ranks, n = self.vocabulary.ranks, len(symbols)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue  # one of the two has been merged since
            symbols[i], symbols[j] = a + b, ""
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y < n and (r := ranks.get((symbols[x], symbols[y]))) is not None:
                    heapq.heappush(heap, (r, x, symbols[x], symbols[y]))
        return [s for s in symbols if s]

    def decode(self, ids: list[int]) -> str:
        """The tokens joined by spaces, as a tokenizer file without a decoder asks."""
        tokens = self.vocabulary.tokens
        return " ".join([tokens[i] for i in ids])

    def id_text(self, ids: list[int]) -> str:
        strings = self.strings
        return " ".join([strings[i] for i in ids])


def round_trip(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: list[str] | None = None, with_ids: bool = False) -> DataFrame:
    """Adds n_tokens, the SHA-256 of the ids as text and of the decoded text, and on request the ids themselves."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def make():
        from hashlib import sha256

        encoder = shared.value.encoder

        def work(texts: pa.Array) -> list:
            counts, ids_sha, decoded_sha, kept = [], [], [], []
            for t in texts:
                ids = encoder.encode(t.as_py())
                counts.append(len(ids))
                ids_sha.append(sha256(encoder.id_text(ids).encode()).hexdigest())
                decoded_sha.append(sha256(encoder.decode(ids).encode()).hexdigest())
                kept.append(ids) if with_ids else None
            return [counts, ids_sha, decoded_sha, *([pa.array(kept, pa.list_(pa.int32()))] if with_ids else [])]

        return work

    fields = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    return with_text_columns(docs, text, fields + [("ids", T.ArrayType(T.IntegerType()))] * with_ids, make, keep)


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: list[str] | None = None, name: str = "n_tokens") -> DataFrame:
    """Adds the encoded length of the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def make():
        encoder = shared.value.encoder
        return lambda texts: [[len(encoder.encode(t.as_py())) for t in texts]]

    return with_text_columns(docs, text, [(name, T.LongType())], make, keep)
