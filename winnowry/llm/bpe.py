"""Encoding with a byte-pair vocabulary by backtracking over longest matches, and decoding by an offset table.

An Aho-Corasick automaton over the vocabulary gives, for every place of a word, the tokens that begin there.  The
encoder takes the longest; a token may stand behind another only if the pair is compatible, that is if merging the two
tokens' bytes by the rules gives these two tokens again.  If no token fits, the encoder steps back and takes a
shorter one.  A place from which no way leads on is never tried twice, so the work is linear in the word's length
(times the longest token), and the result is what applying the merges in order gives.

Compatibility of (a, b) follows from the merge rules alone: a's right edge and b's left edge each grow by a known
series of merges; the pair fails if at some time the two edges themselves merge before either edge grows.

Decoding looks up each id's place in one byte string of all tokens through an array of offsets.

Edge cases: a null or empty text has no ids and decodes to the empty text; rows that repeat are encoded each; texts of
any length are taken whole (they are cut at spaces for the memory's sake, which changes no id); special tokens in a
text are found as the library finds them; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from .common import texts
from .tokens import SLICE

#: Space-separated chunks and words that a worker remembers, each at some 150 bytes.
REMEMBERED = 400_000
#: An end-of-word byte is moved to this range of the alphabet that the automaton sees.
WORD_END = 0xE000


def byte_alphabet() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself if printable, else from 256 on."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """The tables of a tokenizer file with a byte-level BPE model and, possibly, an end-of-word suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("dropout"):
            raise ValueError(f"{path}: not a plain BPE model")
        self.suffix = model.get("end_of_word_suffix") or ""
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.ids: dict[str, int] = model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank: dict[tuple[int, int], int] = {}
        #: of each merged token: the rank of the merge that makes it, its left part, its right part
        self.made: dict[int, tuple[int, int, int]] = {}
        for r, (a, b) in enumerate(merges):
            pair, whole = (self.ids[a], self.ids[b]), self.ids[a + b]
            self.rank[pair] = r
            self.made.setdefault(whole, (r, *pair))
        self.alphabet = byte_alphabet()
        self.ends = {c: chr(WORD_END + b) for b, c in enumerate(self.alphabet)}
        self.spelled = {i: self._spell(t) for t, i in self.ids.items()}

    def _spell(self, token: str) -> str:
        """A token in the automaton's alphabet."""
        if self.suffix and token.endswith(self.suffix):
            body = token[: -len(self.suffix)]
            return body[:-1] + self.ends[body[-1]] if body else token
        return token

    def spell_word(self, word: str) -> str:
        s = "".join([self.alphabet[b] for b in word.encode("utf-8", "surrogatepass")])
        return s[:-1] + self.ends[s[-1]] if self.suffix else s

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """How a token's left (1) or right (2) edge comes about: tokens with the rank that makes each, from bytes on."""
        out = []
        while token in self.made:
            out.append((token, self.made[token][0]))
            token = self.made[token][side]
        out.append((token, -1))
        return out[::-1]

    def compatible(self, a: int, b: int) -> bool:
        right, left = self.edge(a, 2), self.edge(b, 1)
        i = j = 0
        never = 1 << 60
        while True:
            grow_a = right[i + 1][1] if i + 1 < len(right) else never
            grow_b = left[j + 1][1] if j + 1 < len(left) else never
            cross = self.rank.get((right[i][0], left[j][0]), never)
            # Equal ranks are one rule: it is applied from the left on.
            if cross < grow_a and cross <= grow_b and cross < never:
                return False
            if grow_a == never and grow_b == never:
                return True
            if grow_a <= grow_b:
                i += 1
            else:
                j += 1


class Encoder:
    """Ids of words by backtracking, of texts by looking up their chunks and words."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        import ahocorasick
        import regex

        v = self.v = Vocabulary(path)
        self.automaton = ahocorasick.Automaton()
        for i, s in v.spelled.items():
            self.automaton.add_word(s, (len(s), i))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.limit = remembered
        self.words: dict[str, bytes] = {}
        self.chunks = _Chunks(self)
        # The tokenizer's own words: contractions, runs of letters, single digits, runs of other signs.
        self.find = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(v.specials, key=len, reverse=True))) + ")") if v.specials else None

    def _fits(self, a: int, b: int) -> bool:
        ok = self.pairs.get((a, b))
        if ok is None:
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            ok = self.pairs[a, b] = self.v.compatible(a, b)
        return ok

    def merged(self, spelled: str) -> list[int]:
        """The ids that the merges give for a word in the automaton's alphabet."""
        n = len(spelled)
        begin: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, (length, i) in self.automaton.iter(spelled):
            begin[end + 1 - length].append((length, i))
        # Shorter tokens end, and are found, earlier: the last of each list is the longest.
        tried = [len(b) for b in begin]
        dead = set()  # (place, token that ends there): no way leads on
        out: list[int] = []
        at, places = 0, []
        while at < n:
            last = out[-1] if out else -1
            k = tried[at]
            while k:
                k -= 1
                length, i = begin[at][k]
                if (at + length, i) not in dead and (last < 0 or self._fits(last, i)):
                    break
            else:
                if not out:
                    raise ValueError(f"no tokens for {spelled!r}")
                out.pop()
                dead.add((at, last))
                tried[at] = len(begin[at])
                at = places.pop()
                continue
            tried[at] = k
            out.append(i)
            places.append(at)
            at += length
            if at < n:
                tried[at] = len(begin[at])
        return out

    def word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            if len(self.words) >= self.limit:
                self.words.clear()
            found = self.words[word] = array("I", self.merged(self.v.spell_word(word))).tobytes()
        return found

    def plain(self, text: str) -> bytes:
        """Text without special tokens: NFC, lower case by single characters, words."""
        text = unicodedata.normalize("NFC", text)
        # a final sigma is lowered as any other, as the library goes by single characters
        text = text.replace("Σ", "σ").lower() if "Σ" in text else text.lower()
        return b"".join(map(self.word, self.find(text)))

    def chunk(self, text: str) -> bytes:
        if self.special is not None and "<" in text:
            return b"".join(array("I", [self.v.specials[p]]).tobytes() if p in self.v.specials else self.plain(p) for p in self.special.split(text) if p)
        return self.plain(text)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers.  White space parts words, so chunks between spaces stand alone."""
        out, at = [], 0
        while True:
            end = text.find(" ", at + SLICE) if len(text) - at > SLICE else -1
            part = text[at:end] if end >= 0 else text[at:] if at else text
            out.append(b"".join(map(self.chunks.__getitem__, part.split(" "))))
            if end < 0:
                return b"".join(out)
            at = end + 1


class _Chunks(dict):
    """Ids of chunks; a missing one is encoded, a full memory is emptied."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= self.encoder.limit:
            self.clear()
        found = self[chunk] = self.encoder.chunk(chunk)
        return found


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The worker's encoder: the words it has seen serve the worker's later tasks as well."""
    return Encoder(path)


class Decoder:
    """Texts of ids: every token's bytes, with the space that parts tokens, stand in one string with an offset each."""

    #: Ids decoded at a time.
    STEP = 1 << 18

    def __init__(self, vocabulary: Vocabulary):
        named = {**{i: t for t, i in vocabulary.ids.items()}, **{i: t for t, i in vocabulary.specials.items()}}
        size = max(named) + 1
        parts = [(named.get(i, "") + " ").encode() if i in named else b"" for i in range(size)]
        self.offset = np.zeros(size + 1, np.int64)
        np.cumsum([len(p) for p in parts], out=self.offset[1:])
        self.blob = np.frombuffer(b"".join(parts), np.uint8)

    def pieces(self, ids: np.ndarray) -> Iterator[bytes]:
        for at in range(0, len(ids), self.STEP):
            some = ids[at : at + self.STEP]
            start = self.offset[some]
            length = self.offset[some + np.uint32(1)] - start
            ends = np.cumsum(length)
            where = np.repeat(start - (ends - length), length)
            where += np.arange(len(where))
            made = self.blob[where].tobytes()
            yield made if at + self.STEP < len(ids) else made[:-1]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(self.pieces(ids))


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text.  No shuffle."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        enc = encoder(path)
        dec = Decoder(enc.v)
        for batch in batches:
            counts, codes, decoded = [], [], []
            for text in batch.column("text").to_pylist():
                ids = enc.encode(text)
                h = hashlib.sha256()
                for part in dec.pieces(np.frombuffer(ids, "<u4")):
                    h.update(part)
                counts.append(len(ids) // 4)
                codes.append(hashlib.sha256(ids).hexdigest())
                decoded.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(codes, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids, an array of int, of every whole text."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        enc = encoder(path)
        for batch in batches:
            ids = [np.frombuffer(enc.encode(t), "<i4") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(ids: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows with doc_id and ids; null ids are none."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        dec = Decoder(Vocabulary(path))
        for batch in batches:
            out = [dec.decode(np.array(x or [], np.uint32)).decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
