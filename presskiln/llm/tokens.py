"""Encoding whole texts with the public tokenizers, each repeated chunk of text once per task.

A chunk is what stands between single blanks, or less. A chunk encodes alone exactly as it does inside
its text, which each class states for its vocabulary, so a cache of chunks gives the library's ids.
"""

from __future__ import annotations

import re
from array import array
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa

from presskiln.llm.common import KEPT, in_pieces

# Chunks of each of two generations of the cache (an encoder may state another number): the older one
# goes when the newer is full. Longer chunks are not kept, so a generation has at most so many bytes.
GENERATION, LONGEST = 200_000, 128
# Characters of text whose chunks are looked up together.
PIECE_CHARS = 2 << 20
_ENCODERS = KEPT["encoders"]
STOPS = (",", ".")
# Byte-level form of the bytes that Latin-1 letters and a blank before them have, as code points.
_BYTE_LEVEL = np.arange(256, dtype="<u2")
_BYTE_LEVEL[0x80:0xA1] = np.arange(0x122, 0x143)
_BYTE_LEVEL[[0x20, 0xAD]] = 0x120, 0x143
LATIN = frozenset(c for c in map(chr, range(256)) if c.isalpha() and c not in "ªµº" or c in "0123456789")
# Bytes that end a Latin letter or digit: all of ASCII's, and behind 0xC3 all but two signs. And ASCII's signs.
_ALNUM = np.array([b < 128 and chr(b) in LATIN for b in range(256)])
_BEHIND_C3 = np.array([b >= 0x80 and b not in (0x97, 0xB7) for b in range(256)])
_SIGN = np.array([32 < b < 127 and chr(b) not in LATIN for b in range(256)])


class Cache(dict):
    """Chunk to value; what is missing comes from ``make``. Memory is bounded."""

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= GENERATION:
            self.older = dict(self)
            self.clear()
        if len(key) <= LONGEST:
            self[key] = value
        return value


def _library(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class _ChunkEncoder:
    """Ids of chunks from the library, several thousand unknown ones in a few calls.

    Unknown chunks are joined by a special token of the vocabulary, at which the library cuts a
    text before anything else, or by nothing where they can stand ``beside`` each other; chunks
    that hold a special token's text are encoded one by one. A chunk of Latin-1 letters is one
    pre-token that no normal form changes, so the library's model gets it as it is.
    ``joined`` unknown chunks are one call's text, the number at which a class is fastest.
    A comma or full stop behind a Latin letter or digit is a pre-token of its own at the end of a
    chunk, so such chunks are made of two known ones.
    """

    generation = GENERATION

    def __init__(self, path: str):
        self.library = _library(path)
        special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.mark, self.mark_id = next(iter(special.items()))
        self.special = tuple(special)
        self.blanks = any(" " in s for s in special)
        self.leads = np.zeros(1 << 16, bool)  # tokens that begin with a blank, in byte-level form
        self.leads[[i for t, i in self.library.get_vocab().items() if t.startswith("\u0120")]] = True
        self.stops = {c: self._one(c) for c in STOPS}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _one(self, chunk: str) -> bytes:
        return np.array(self.library.encode(chunk, add_special_tokens=False).ids, np.uint16).tobytes()

    def _learn(self, chunks: set[str], special: bool) -> None:
        if len(self.known) > self.generation:
            self.older, self.known = self.known, {}
        known, new = self.known, self._recalled(chunks)
        for chunk in [c for c in new if any(s in c for s in self.special)] if special else ():
            known[chunk] = self._one(chunk)
            new.discard(chunk)
        ended = [c for c in new if c.endswith(STOPS) and c[-2:-1] in LATIN]
        new.difference_update(ended)
        new |= self._recalled({c[:-1] for c in ended})
        plain = list(filter(self.plain, new))
        new.difference_update(plain)
        known.update(zip(plain, self._modelled(plain), strict=True))
        beside = [c for c in new if self.beside(c)]
        self._encode(beside, "")
        self._encode(list(new.difference(beside)), self.mark)
        for chunk in ended:
            known[chunk] = known[chunk[:-1]] + self.stops[chunk[-1]]

    def _recalled(self, chunks: set[str]) -> set[str]:
        """The chunks that are not known; what the older generation has becomes known."""
        new, older = chunks.difference(self.known), self.older
        kept = [c for c in new if c in older]
        self.known.update(zip(kept, map(older.__getitem__, kept), strict=True))
        new.difference_update(kept)
        return new

    def _modelled(self, words: list[str]) -> list[bytes]:
        """Ids of plain chunks, brought into byte-level form all at once, from the library's model."""
        if not words:
            return []
        codes = _BYTE_LEVEL[np.frombuffer("\n".join(words).encode(), np.uint8)]
        tokenize = self.library.model.tokenize
        return [array("H", [t.id for t in tokenize(w)]).tobytes() for w in codes.tobytes().decode("utf-16-le").split("\n")]

    def beside(self, chunk: str) -> bool:
        """Whether the chunk may stand right behind another one, its first token telling where."""
        return False

    def _encode(self, chunks: list[str], mark: str) -> None:
        """Ids of unknown chunks, some of them at a time, joined by the mark or by nothing."""
        groups = [chunks[k : k + self.joined] for k in range(0, len(chunks), self.joined)]
        joined = [mark.join(g) for g in groups]
        for group, found in zip(groups, self.library.encode_batch_fast(joined, add_special_tokens=False), strict=True):
            ids = np.array(found.ids, np.uint16)
            at = np.flatnonzero(ids == self.mark_id) if mark else np.flatnonzero(self.leads[ids])[1:]
            data, begin = ids.tobytes(), 0
            for chunk, end in zip(group, (2 * np.append(at, len(ids))).tolist(), strict=True):
                self.known[chunk] = data[begin:end]
                begin = end + 2 * bool(mark)

    def chunks(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The chunks of all texts in order, and how many stand before each text and in all."""
        cut = list(map(self.cut, texts))
        return pa.array(chain.from_iterable(cut), pa.large_string()), np.cumsum([0, *map(len, cut)])

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 16-bit integers.

        The chunks of some texts are numbered, only different ones are looked up.
        """
        out: list[bytes] = []
        for begin, end in in_pieces(map(len, texts), PIECE_CHARS):
            some = texts[begin:end]
            chunks, first = self.chunks(some)
            numbered = chunks.dictionary_encode()
            names = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
            self._learn(set(names), any(s in t for s in self.special for t in some))
            values = pa.array(map(self.known.__getitem__, names), pa.large_binary())
            _, places, ids = values.take(numbered.indices).buffers()
            edges = np.frombuffer(places, np.int64)[first].tolist()
            out += [ids[a:b].to_pybytes() if a < b else b"" for a, b in pairwise(edges)]
            long = max(map(len, names), default=0) > LONGEST
            for chunk in [c for c in self.known if len(c) > LONGEST] if long else ():
                del self.known[chunk]
        return out


class ByteEncoder(_ChunkEncoder):
    """Byte-level BPE whose pre-tokens may begin with one blank.

    A single white-space character between two others begins a pre-token: runs are the only
    pre-tokens with white space inside, a blank belongs to what follows and a line end stands
    alone. No pre-token goes on from a letter or digit to a sign, so an ASCII sign behind a Latin
    letter or digit begins one too. Texts with longer runs, other white space or a special token
    are cut only at the blanks a pattern finds.
    """

    joined, generation = 50, 300_000
    plain = staticmethod(re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch)
    _cut = re.compile(r"(?<=\S)(?= \S)")

    def beside(self, chunk: str) -> bool:
        """A blank, then no white space: its first pre-token, and no other, begins with a blank."""
        return chunk.rfind(" ") == 0 and len(chunk) > 1 and chunk.isprintable() and not self.blanks

    def chunks(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """All texts are cut at once, by their bytes; the pattern is for those it is needed for."""
        data = [t.encode() for t in texts]
        begins = np.cumsum([0, *map(len, data)])
        codes = np.frombuffer(b"".join(data), np.uint8)
        line = codes == 10
        white = line | (codes == 32)
        latin = _ALNUM[codes]
        latin[1:] |= (codes[:-1] == 0xC3) & _BEHIND_C3[codes[1:]]
        starts = white.copy()
        starts[1:] |= line[:-1] | latin[:-1] & _SIGN[codes[1:]]
        starts[begins[:-1][np.diff(begins) > 0]] = True
        runs = np.flatnonzero(white[1:] & white[:-1]) + 1
        for k in sorted({*(np.searchsorted(begins, runs, "right") - 1).tolist(), *self._special_texts(texts)}):
            parts = [len(c.encode()) for c in self._cut.split(texts[k])]
            starts[begins[k] : begins[k + 1]] = False
            starts[begins[k] + np.cumsum([0, *parts[:-1]])] = True
        places = np.flatnonzero(starts)
        offsets = pa.py_buffer(np.append(places, len(codes)))
        return pa.LargeStringArray.from_buffers(len(places), offsets, pa.py_buffer(codes)), np.searchsorted(places, begins)

    def _special_texts(self, texts: list[str]) -> list[int]:
        """Places of texts that hold a special token or white space other than blanks and line ends."""
        whole = "".join(texts)
        if whole.replace("\n", "").isprintable() and not any(s in whole for s in self.special):
            return []
        odd = [not t.replace("\n", "").isprintable() or any(s in t for s in self.special) for t in texts]
        return np.flatnonzero(odd).tolist()


class WordEncoder(_ChunkEncoder):
    """BPE whose pre-tokens hold no white space, which is dropped: every blank is a cut.

    Normal form and lower case do not look across a blank either. A text of Latin-1 characters is in
    normal form, and each has one lower case, so its chunks are looked up in lower case.
    """

    joined = 400
    plain = staticmethod(re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+").fullmatch)

    def cut(self, text: str) -> list[str]:
        return self._lowered(text).replace("\n", " ").split(" ")

    def _lowered(self, text: str) -> str:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        low = text.lower()
        return text if any(s in low for s in self.special) else low


def encoder(kind: type, path: str):
    """The encoder of a worker process, kept from task to task."""
    if (kind, path) not in _ENCODERS:
        _ENCODERS[kind, path] = kind(path)
    return _ENCODERS[kind, path]
