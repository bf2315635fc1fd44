"""Cached exact encoding with the tokenizers library.

Both public tokenizers split a text at white space before any merge, so a text
is encoded as the concatenation of its chunks, and chunks repeat. A bounded
dictionary per Python worker maps a chunk to its ids (as bytes); chunks that
are not in it go to the library in one batch.

* ``byte``: a chunk starts at the text's start or at a space that is followed
  by a character other than white space. The byte-level pattern never matches
  across such a place, and reads such a space as the first character of the
  next word. A line feed between other characters than white space is a word of
  its own, and what follows it begins like a text.
* ``word``: the normaliser makes every run of white space one space, the
  pattern drops it, and neither NFC nor lower-casing looks across it; chunks are
  the parts between spaces and line feeds (other white space stays inside a
  chunk, for the library to split). A text in NFC is lower-cased first, unless
  it holds one of the two letters whose lower case depends on the method.

A chunk that is not known is taken apart further: a full stop or comma after a
Latin letter at the end of a line is a word of its own in both patterns.

Texts are encoded in parts of about ``part_chars``: Arrow numbers the chunks of
a part, the dictionary is asked once for each different chunk, and numpy lays
the ids out in the order of the text.
"""

from __future__ import annotations

import functools
import json
import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import islice, pairwise
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# a space followed by white space (or, for the end of a text, by nothing)
_ODD_SPACE = re.compile(r" (?!\S)")
_BREAK = re.compile(r" (?=\S)")
_CUT = "\x01"  # stands between chunks while a part is split
# chunks that are kept, some 200 bytes each: a pipeline's idle workers keep the ones of
# kind byte, in two tables; kind word has one table and fills it with lower-case words
KNOWN = {"byte": 200_000, "word": 1_000_000}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[str, int]:
    """Letter of a byte in the vocabulary -> byte: printable Latin-1 stands for
    itself, the other bytes follow from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def merger(path: str) -> Callable[[bytes], list[int]] | None:
    """A faster merger of one word for a byte-level tokenizer, or None.

    It merges the neighbours whose concatenation has the lowest id, whichever
    pair it is. That equals merging listed pairs in their order if ids grow
    along the list and every token, spelled out, merges back to itself: had two
    neighbours another spelling of a token, that token alone would stop there
    too. Both conditions are checked here.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    letters, vocab = _byte_letters(), model["vocab"]
    if not letters.keys() <= vocab.keys():
        return None
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    ids = [vocab["".join(p)] for p in pairs]
    if any(a >= b for a, b in pairwise(ids)) or (ids and min(ids) <= max(vocab[c] for c in letters)):
        return None
    order = {p: i for i, p in enumerate(pairs)}
    for a, b in pairs:
        word = list(a + b)
        while len(word) > 1:
            best, i = min((order.get(p, len(order)), i) for i, p in enumerate(pairwise(word)))
            if best == len(order):
                return None
            word[i : i + 2] = ["".join(word[i : i + 2])]
    ranks = {bytes([b]): vocab[c] for c, b in letters.items()}
    ranks |= {bytes(letters[c] for c in a + b): n for (a, b), n in zip(pairs, ids)}
    return tiktoken.Encoding("bytes", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece


class ChunkEncoder:
    def __init__(self, path: str, kind: str, limit: int | None = None, part_chars: int = 2_000_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True  # their strings in a text are ordinary text
        self.kind, self.part = kind, part_chars
        self.limit = KNOWN[kind] if limit is None else limit
        self.dtype = np.dtype("<u2") if self.tok.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.merge = merger(path) if kind == "byte" else None
        # by what stands before a chunk: nothing, or (kind byte) a space
        self.known: dict[str, dict[str, bytes]] = {"": {}, " ": {}}

    def _marked(self, text: str) -> str | None:
        """The text with ``_CUT`` between its chunks; None if it holds one."""
        if _CUT in text:
            return None
        if self.kind == "word":
            if "Σ" not in text and "İ" not in text and is_normalized("NFC", text):
                text = text.lower()  # as the normaliser does, so that chunks repeat more often
            return text.replace("\n", _CUT).replace(" ", _CUT)
        return _BREAK.sub(_CUT, text) if _ODD_SPACE.search(text) else text.replace(" ", _CUT)

    def _atoms(self, chunk: str) -> list[str]:
        """Parts of a chunk with independent ids; only the first one has the
        chunk's space before it."""
        if "\n" in chunk:
            lines = chunk.split("\n")
            if "" in lines or lines != chunk.split():
                return [chunk]
            return [*self._atoms(lines[0]), *(a for x in lines[1:] for a in ("\n", *self._atoms(x)))]
        if chunk[-1:] in (".", ",") and "" < chunk[-2:-1] < "\u0250" and chunk[-2].isalpha():
            return [chunk[:-1], chunk[-1]]
        return [chunk]

    def _encoded(self, atoms: set[str], lead: str) -> dict[str, bytes]:
        cache = self.known[lead]
        got = {a: cache.get(a) for a in atoms}
        new = [a for a, ids in got.items() if ids is None]
        rest = new
        if self.merge is not None:
            # Latin letters with at most a space before them are one word of the pattern
            letters = [a for a in new if a.isalpha() and max(a) < "\u0250"]
            got.update((a, array(self.code, self.merge((lead + a).encode())).tobytes()) for a in letters)
            rest = [a for a in new if got[a] is None]
        for s in range(0, len(rest), 20_000):
            part = rest[s : s + 20_000]
            found = self.tok.encode_batch_fast([lead + w for w in part] if lead else part, add_special_tokens=False)
            got.update(zip(part, (array(self.code, e.ids).tobytes() for e in found)))
        self._keep(cache, ((a, got[a]) for a in new))
        return got

    def _keep(self, cache: dict[str, bytes], items: Iterable[tuple[str, bytes]]) -> None:
        """Frequent chunks are met early, so a full cache stays as it is."""
        if len(cache) < self.limit:
            cache.update(islice(items, self.limit - len(cache)))

    def _ids(self, chunks: list[str], lead: str) -> list[bytes]:
        cache = self.known[lead]
        got = list(map(cache.get, chunks))
        missing = [i for i, ids in enumerate(got) if ids is None]
        if not missing:
            return got
        atoms = {c: self._atoms(c) for c in {chunks[i] for i in missing}}
        first = self._encoded({a[0] for a in atoms.values()}, lead)
        later = self._encoded({x for a in atoms.values() for x in a[1:]}, "")
        once = {c: b"".join([first[a[0]], *map(later.__getitem__, a[1:])]) for c, a in atoms.items()}
        for i in missing:
            got[i] = once[chunks[i]]
        # chunks over a line feed hardly repeat
        self._keep(cache, ((c, ids) for c, ids in once.items() if len(atoms[c]) == 2))
        return got

    def _encode_some(self, texts: list[str]) -> list[bytes]:
        marked = [self._marked(t) for t in texts]
        if None in marked:  # a text that holds the mark is one chunk
            done = iter(self._encode_some([t for t, m in zip(texts, marked) if m is not None]))
            return [next(done) if m is not None else self._ids([t], "")[0] for t, m in zip(texts, marked)]
        if not texts:
            return []
        chunks = pc.split_pattern(pa.array(marked, pa.string()), _CUT)
        at = chunks.offsets.to_numpy()
        numbered = chunks.values.dictionary_encode()
        codes = numbered.indices.to_numpy(zero_copy_only=False).copy()
        different = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        byte = self.kind == "byte"
        ids = self._ids(different, " " if byte else "")
        if byte:  # the first chunk of a text has no space before it
            heads = self._ids([different[i] for i in codes[at[:-1]]], "")
            codes[at[:-1]] = np.arange(len(ids), len(ids) + len(heads))
            ids += heads
        width = self.dtype.itemsize
        # a part has far fewer than 2^31 ids
        size = np.fromiter(map(len, ids), np.int32, len(ids)) // width
        table = np.frombuffer(b"".join(ids), self.dtype)
        starts = np.cumsum(size, dtype=np.int32) - size
        n = size[codes]
        ends = np.cumsum(n, dtype=np.int32)
        out = table[np.repeat(starts[codes] - ends + n, n) + np.arange(ends[-1], dtype=np.int32)].tobytes()
        cuts = (np.concatenate([[0], ends])[at] * width).tolist()
        return [out[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def _pieces(self, text: str) -> Iterator[str]:
        """Parts of a long text, cut where encoding is independent. A later
        part of kind ``byte`` starts with its space."""
        at = 0
        while len(text) - at > self.part:
            m = _BREAK.search(text, at + self.part)
            if not m:
                break
            yield text[at : m.start()]
            at = m.start()
        yield text[at:]

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text, as little-endian ``dtype`` bytes."""
        batch: list[str] = []
        size = 0
        for t in texts:
            t = t or ""
            if len(t) > 2 * self.part:
                yield from self._encode_some(batch)
                batch, size = [], 0
                # a part after the first begins with a space: kept in its first chunk
                yield b"".join(b for p in self._pieces(t) for b in self._encode_some([p]))
                continue
            batch.append(t)
            size += len(t)
            if size >= self.part:
                yield from self._encode_some(batch)
                batch, size = [], 0
        if batch:
            yield from self._encode_some(batch)


@functools.lru_cache(maxsize=2)
def encoder(path: str, kind: str) -> ChunkEncoder:
    """The encoder of this Python worker: later tasks find its chunks known."""
    return ChunkEncoder(path, kind)
