"""SentencePiece BPE encoding by backtracking, and decoding.

The model merges, again and again, the adjacent pair whose joined piece has
the highest score (leftmost on ties). The same result is found without a
queue of merges: walk the text taking the longest piece that an Aho-Corasick
automaton finds at the position; accept it after the previous piece only if the
two are compatible, i.e. merging their joined text alone gives exactly these
two pieces; otherwise try the next shorter piece; when none is left, mark the
position in a bitfield of failed positions and step back. A sequence in which
every adjacent pair is compatible is the merge result of the whole text.

Characters without a piece become their UTF-8 byte pieces and never merge. The
text is cut before each run of the space mark and around characters that occur
in no longer piece, provided no piece crosses such a place (checked on the
model), so equal segments are encoded once per worker.

Defined cases. Null and empty texts have no ids and decode to the empty text.
White space is kept as the model's normaliser keeps it. Nulls in other columns,
repeated rows and extra columns do not matter; an empty table gives an empty
result.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import tokenizer_path

SPACE = "▁"


class PieceEncoder:
    def __init__(self, model_file: str, limit: int = 500_000):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.lib = sentencepiece.SentencePieceProcessor(model_file=model_file)
        m = pb.ModelProto()
        with open(model_file, "rb") as f:
            m.ParseFromString(f.read())
        t, nz = m.trainer_spec, m.normalizer_spec
        kinds = {p.type for p in m.pieces}
        if t.model_type != 2 or t.treat_whitespace_as_suffix or not kinds <= {1, 2, 3, 6}:
            raise ValueError("only BPE models without user-defined pieces are supported")
        self.plain = nz.name == "identity" and not nz.precompiled_charsmap and not nz.remove_extra_whitespaces
        self.dummy, self.escape = nz.add_dummy_prefix, nz.escape_whitespaces
        self.byte_id = {int(p.piece[1:-1], 16): i for i, p in enumerate(m.pieces) if p.type == 6}
        self.unk = next(i for i, p in enumerate(m.pieces) if p.type == 2)
        self.id = {p.piece: i for i, p in enumerate(m.pieces) if p.type == 1}
        self.score = {p.piece: p.score for p in m.pieces if p.type == 1}
        self.limit = limit
        self.known: dict[str, list[int]] = {}
        self.fits: dict[tuple[str, str], bool] = {}
        # pieces that merging can reach; shorter ones for each are their prefixes
        self.auto = ahocorasick.Automaton()
        usable = [p for p in self.id if len(p) == 1 or self._merge(p) == [p]]
        for p in usable:
            # reversed: a match ending at i of the reversed text starts at n-1-i
            self.auto.add_word(p[::-1], p)
        self.auto.make_automaton()
        usable_set = set(usable)
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in usable_set), None) for p in usable}
        joined = {c for p in self.id if len(p) > 1 for c in p}
        crossing = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.id)
        alone = "".join(re.escape(c) for c in "\n\t\r" if c not in joined)
        self.cut = None if crossing else re.compile(
            (f"[{alone}]|" if alone else "") + f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+"
        )

    def _merge(self, text: str) -> list[str]:
        """Pieces of a short text by merging in order of score."""
        parts: list[str | None] = list(text)
        n = len(parts)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            j = right[i]
            if j < n:
                s = parts[i] + parts[j]
                if s in self.score:
                    heapq.heappush(heap, (-self.score[s], i, s))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, s = heapq.heappop(heap)
            j = right[i] if parts[i] is not None else n
            if j >= n or parts[i] + parts[j] != s:
                continue
            parts[i], parts[j] = s, None
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        return [p for p in parts if p is not None]

    def _fit(self, a: str, b: str) -> bool:
        ok = self.fits.get((a, b))
        if ok is None:
            if len(self.fits) >= self.limit:
                self.fits.clear()
            ok = self.fits[a, b] = self._merge(a + b) == [a, b]
        return ok

    def _segment(self, text: str) -> list[int]:
        whole = self.id.get(text)
        if whole is not None and text in self.shorter:
            return [whole]
        n = len(text)
        longest: list[str | None] = [None] * n
        for end, p in self.auto.iter(text[::-1]):
            start = n - 1 - end
            if longest[start] is None or len(p) > len(longest[start]):
                longest[start] = p
        failed = bytearray((n >> 3) + 1)
        stack: list[str | None] = []  # None: a character without a piece
        at = 0
        nxt: str | None = longest[0] if n else None
        while at < n:
            if longest[at] is None:
                stack.append(None)
                at += 1
                nxt = longest[at] if at < n else None
                continue
            p = nxt
            placed = False
            prev = stack[-1] if stack else None
            while p is not None:
                end = at + len(p)
                if not failed[end >> 3] >> (end & 7) & 1 and (prev is None or self._fit(prev, p)):
                    placed = True
                    break
                p = self.shorter[p]
            if placed:
                stack.append(p)
                at += len(p)
                nxt = longest[at] if at < n else None
                continue
            failed[at >> 3] |= 1 << (at & 7)
            last = stack.pop()
            while last is None:  # a lone character cannot be the reason
                at -= 1
                last = stack.pop()
            at -= len(last)
            nxt = self.shorter[last]
        out: list[int] = []
        at = 0
        for p in stack:
            if p is None:
                if self.byte_id:
                    out.extend(self.byte_id[c] for c in text[at].encode("utf-8", "replace"))
                else:
                    out.append(self.unk)
                at += 1
            else:
                out.append(self.id[p])
                at += len(p)
        return out

    def normalized(self, text: str) -> str:
        if not self.plain:
            return self.lib.normalize(text)
        if not text:
            return ""
        text = (" " if self.dummy else "") + text
        return text.replace(" ", SPACE) if self.escape else text

    def encode(self, text: str | None) -> list[int]:
        text = self.normalized(text or "")
        if not text:
            return []
        if self.cut is None:
            return self._segment(text)
        known = self.known
        out: list[int] = []
        for s in self.cut.findall(text):
            ids = known.get(s)
            if ids is None:
                ids = self._segment(s)
                if len(known) < self.limit and len(s) <= 64:
                    known[s] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        return self.lib.decode(ids)


@functools.lru_cache(maxsize=1)
def piece_encoder(model_file: str) -> PieceEncoder:
    """The encoder of this Python worker: later tasks find its segments known."""
    return PieceEncoder(model_file)


def encode_decode(docs: DataFrame, model_file: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids, decoded)."""
    model_file = model_file or tokenizer_path("piece_bpe_32k.model")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = piece_encoder(model_file)
        words = [str(i) for i in range(enc.lib.get_piece_size())]
        for b in batches:
            for s in range(0, len(b), 1000):
                p = b.iloc[s : s + 1000]
                ids = [enc.encode(t) for t in p["text"]]
                text = [enc.decode(x) if x else "" for x in ids]
                out = pd.DataFrame(
                    {
                        "doc_id": p["doc_id"].astype("Int64").to_numpy(dtype=object, na_value=None),
                        "n_tokens": [len(x) for x in ids],
                        "ids_sha256": [hashlib.sha256(",".join([words[i] for i in x]).encode()).hexdigest() for x in ids],
                        "decoded_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in text],
                    }
                )
                out["doc_id"] = out["doc_id"].astype("Int64")
                if with_ids:
                    out["ids"], out["decoded"] = ids, text
                yield out

    extra = ", ids array<int>, decoded string" if with_ids else ""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + extra
    )
