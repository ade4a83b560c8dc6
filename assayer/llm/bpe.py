"""Byte-level BPE: longest-match backtracking over an Aho-Corasick automaton of the vocabulary."""
from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from assayer.llm.scan import Recent, scan, slices, texts

PIECES, PAIRS = 320_000, 400_000
#: Longer pieces (in characters) aren't remembered; pieces of more bytes are matched where a token can begin, not everywhere.
REMEMBERED, LONG = 64, 2_048
_LATIN = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_OTHER = re.compile(r"[^\t\n\r -~¡-¨«¬®-±´¶-¸»¿À-ɏ‐-‧‰-⁞]")
_PLAIN = re.compile(rf" ?[{_LATIN}]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[^\s{_LATIN}0-9]+|\s+(?!\S)|\s+")


def pieces(text: str, pattern: regex.Pattern) -> list[str]:
    """The matches of ``pattern``. Text of Latin letters and ASCII signs alone goes through an equal, faster expression."""
    return pattern.findall(text) if _OTHER.search(text) else _PLAIN.findall(text)


class PairwiseBpe:
    """Exact BPE of one piece without merging it.

    A token sequence is what merging yields if and only if each adjacent pair survives merging by itself. So each prefix has
    one sequence, tokens are tried longest first, and a position from which nothing fits is never tried again: the number of
    tests is bounded by the number of vocabulary matches in the piece.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.bytes_of = ranks, {r: t for t, r in ranks.items()}
        self.found = ahocorasick.Automaton()
        for t, r in ranks.items():
            self.found.add_word(t.decode("latin-1"), (r, len(t)))
        self.found.make_automaton()
        self.pairs, self.longest = Recent(PAIRS), max(map(len, ranks))

    def merge(self, data: bytes) -> list[int]:
        """Plain merging, lowest rank first: the definition. Only used on two neighbouring tokens."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while True:
            best = min(((r, i) for i in range(len(parts) - 1) if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None), default=None)
            if best is None:
                return [self.ranks[p] for p in parts]
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    def stays(self, a: int, b: int) -> bool:
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            known = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
            self.pairs.put(key, known)
        return known

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None or not piece:
            return [whole] if piece else []
        n = len(piece)
        if n > LONG:
            return self._encode_long(piece)
        starts: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, (rank, size) in self.found.iter(piece.decode("latin-1")):
            starts[end - size + 1].append((rank, size))  # ends rise, so the longest is last
        dead, at, out = bytearray(n + 1), 0, []
        while at < n:
            untried = starts[at]
            while untried:
                rank, size = untried.pop()
                if not dead[at + size] and (not out or self.stays(out[-1], rank)):
                    out.append(rank)
                    at += size
                    break
            else:
                if not out:
                    raise ValueError("the vocabulary lacks a byte of the text")
                dead[at] = 1
                at -= len(self.bytes_of[out.pop()])
        return out

    def _encode_long(self, piece: bytes) -> list[int]:
        """The same for a long piece. Matches are looked up when a position is first reached, longest first, by the longest path of
        the vocabulary's trie; what is kept grows with the tokens and not with all matches of the piece."""
        n, letters = len(piece), piece.decode("latin-1")
        dead, at, out, left = bytearray(n + 1), 0, [], []
        size = self.found.longest_prefix(letters[:self.longest])
        while at < n:
            while size:
                rank = self.ranks.get(piece[at:at + size])
                if rank is not None and not dead[at + size] and (not out or self.stays(out[-1], rank)):
                    break
                size -= 1
            if size:
                out.append(rank)
                left.append(size)  # the next one to try here is shorter
                at += size
                size = self.found.longest_prefix(letters[at:at + self.longest])
                continue
            if not out:
                raise ValueError("the vocabulary lacks a byte of the text")
            dead[at] = 1
            out.pop()
            size = left.pop()
            at -= size
            size -= 1
        return out


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}


class Codec:
    """Text to ids and back, with a bounded cache of pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.bpe, self.pattern, self.cache = PairwiseBpe(ranks), regex.compile(pattern), Recent(PIECES)
        self.digits = {r: str(r) for r in ranks.values()}

    def _new(self, piece: str) -> tuple[int, ...]:
        known = self.cache.get(piece)
        if known is None:
            known = tuple(self.bpe.encode(piece.encode()))
            if len(piece) <= REMEMBERED:
                self.cache.put(piece, known)
        return known

    def encode(self, text: str) -> list[int]:
        near = self.cache.young.get
        return list(chain.from_iterable([near(p) or self._new(p) for p in pieces(text, self.pattern)]))

    def printed(self, ids: list[int]) -> str:
        """Decimal ids, joined by one space."""
        return " ".join(map(self.digits.__getitem__, ids))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bpe.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process and vocabulary."""
    return Codec(read_ranks(path), pattern)


def encode_documents(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                     ids: bool = True) -> DataFrame:
    """(doc_id, [ids,] n_tokens, ids_sha256, decoded_sha256) per row of ``df``, whole texts.

    A null text is an empty one and has no ids. Ids are passed through, null or repeated; other columns are not read. A long
    text is worked on by itself; the caches of pieces and pairs are bounded.
    """
    kind = dict(df.dtypes)[id_col]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in slices(batches, text_col):
            lists, counts, printed, decoded = [], [], [], []
            for t in texts(b, text_col):
                got = c.encode(t)
                counts.append(len(got))
                printed.append(hashlib.sha256(c.printed(got).encode()).hexdigest())
                decoded.append(hashlib.sha256(c.decode(got)).hexdigest())
                if ids:
                    lists.append(got)
            cols = [b.column(0), *([pa.array(lists, pa.list_(pa.int32()))] if ids else []), pa.array(counts, pa.int64()), pa.array(printed, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, [id_col, *(["ids"] if ids else []), "n_tokens", "ids_sha256", "decoded_sha256"])

    return scan(df.select(id_col, text_col), task, f"`{id_col}` {kind}, {'ids array<int>, ' if ids else ''}n_tokens long, ids_sha256 string, decoded_sha256 string")
