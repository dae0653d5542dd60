"""Encoding of whole texts with a tokenizer file, made fast by remembering the ids of space-separated chunks.

A byte-level BPE never merges across the words its pre-tokenizer finds, and no such word holds a space behind a
character that is not white space.  So a text cut before those spaces, around single new lines, and between a letter
and a sign that ends a chunk, has the ids of its chunks, joined.  A chunk that has not been seen is encoded by the
tokenizers library: one that is a run of Latin letters by the library's BPE model, any other by the whole tokenizer.
The model's way, and the cut in front of signs, are taken only if they give what the tokenizer gives for a list of
probes.

What is remembered is bounded in number and in the length of keys; when the memory is full, only what has been asked
for since the last time stays.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

#: Chunks of a generation that a worker remembers: at some 250 bytes each, and a kilobyte at most.
CHUNKS = 300_000
#: Characters split at a time, so that a very long text is never held as one list of chunks.
SLICE = 1 << 20

#: Letters that are their own composed form and have one small letter; a sign behind one that ends a chunk, which is a word of its own.
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_WORD = re.compile(f"[{_LETTER}]+").fullmatch
_SIGN = re.compile(rf"([,.;:!?])(?<=[{_LETTER}][,.;:!?])(?=[ \n]|\Z)").sub
#: In a key: no space in front.
_BARE = "\x01"
#: White space besides the space and the new line; white space with one of these behind it.
_RARE = tuple(chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n")
_SPACED = re.compile(r"\s[ \n]").search
_PROBES = ("a", "Word", "OUwhea", "Élève", "straße", "don", "l", "s", "t", "ÿ", "Ðð", "thonentithst", "Extraordinarily", "çàéêüöäñ")


def load(path: str):
    """The tokenizer in ``path``, single-threaded, without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


@lru_cache(maxsize=1)
def encoder(path: str, glued: bool) -> ChunkEncoder:
    """The worker's encoder for a tokenizer file: what it has learned serves the worker's later tasks as well."""
    return ChunkEncoder(load(path), glued)


class Memo(dict):
    """What ``make`` gives for a key.  Two generations of ``entries`` are remembered; keys over ``LONG`` are not."""

    LONG = 48

    def __init__(self, make: Callable[[str], bytes], entries: int):
        self.make, self.entries, self.before = make, entries, {}

    def __missing__(self, key: str) -> bytes:
        if len(key) > self.LONG:
            return self.make(key)
        found = self.before.get(key)
        if found is None:
            found = self.make(key)
        if len(self) >= self.entries:
            self.before = dict(self)
            self.clear()
        self[key] = found
        return found


class ChunkEncoder:
    """Ids of texts, as bytes of little-endian unsigned 32-bit integers.

    ``glued``: a space belongs to the word behind it (byte-level BPE without white-space removal); else white space
    is dropped by the tokenizer, letters are lowered, and chunks stand alone.
    """

    def __init__(self, tokenizer, glued: bool, chunks: int = CHUNKS):
        self.tok, self.glued, self.model = tokenizer, glued, tokenizer.model
        keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        rest = iter(range(256, 512))
        self.alphabet = {b: b if b in keep else next(rest) for b in range(256)}  # of byte-level vocabularies
        self.space = chr(self.alphabet[32])
        self.chunks = Memo(self._chunk, chunks)
        self.by_model = True
        probes = [f"{a}{w}{end}" for w in _PROBES for a in ("", "x ", "x\n", "x, ") for end in ("", ",", ".\ny", "! y")]
        self.by_model = [self.encode(t) for t in probes] == [self._raw(t) for t in probes]
        self.chunks.clear()

    def _raw(self, text: str) -> bytes:
        return array("I", self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def _spelled(self, word: str) -> str:
        """A word in the characters of the vocabulary."""
        return word if word.isascii() else word.encode("utf-8").decode("latin-1").translate(self.alphabet)

    def _chunk(self, key: str) -> bytes:
        bare = key[:1] == _BARE if self.glued else True
        text = key[1:] if key[:1] == _BARE and self.glued else key
        if not self.by_model or not _WORD(text):
            return self._raw(text if bare else " " + text)
        word = self._spelled(text if self.glued else text.lower())
        return array("I", [t.id for t in self.model.tokenize(word if bare else self.space + word)]).tobytes()

    def _slices(self, text: str) -> Iterator[list[str]]:
        at = 0
        while True:
            end = text.find(" ", at + SLICE) if len(text) - at > SLICE else -1
            part = text[at:end] if end >= 0 else text[at:] if at else text
            # White space around a new line is ruled out, or else dropped by the tokenizer as the new line is
            if self.glued:
                if self.by_model:
                    part = _SIGN(f" {_BARE}\\1", part)
                part = part.replace("\n", f" {_BARE}\n {_BARE}")
                yield (part if at else _BARE + part).split(" ")
            else:
                if self.by_model:
                    part = _SIGN(r" \1", part)
                part = part.replace("\n", " ")
                yield (part.lower() if part.isascii() else part).split(" ")
            if end < 0:
                return
            at = end + 1

    @staticmethod
    def _parted(text: str) -> bool:
        """Whether every space and new line stands alone, behind what is not white space."""
        if text[:1].isspace() or "  " in text or "\n " in text or " \n" in text or "\n\n" in text or _BARE in text:
            return False
        return not any(c in text for c in _RARE) or _SPACED(text) is None

    def encode(self, text: str) -> bytes:
        # A space or a new line behind white space or at the start is no place to cut: such a text is encoded as a whole.
        if self.glued and not self._parted(text):
            return self._raw(text)
        out = [b"".join(map(self.chunks.__getitem__, keys)) for keys in self._slices(text)]
        return out[0] if len(out) == 1 else b"".join(out)

    def encode_all(self, texts: Iterable[str]) -> list[bytes]:
        return [self.encode(t) for t in texts]
