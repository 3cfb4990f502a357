"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece of bytes exactly one token can be the last one of its encoding. That token is stored per prefix:
token ``t`` of length ``L`` is the last of prefix ``i`` if ``(last[i-L], t)`` is a pair that merging leaves apart. Reading
the stored tokens from the end gives the encoding of every prefix, so bytes can be appended for the price of the new bytes,
and an edit only recomputes prefixes until the stored tokens agree with the old ones again.

Results equal merging by rank: a piece that is itself a token is that token; other pieces are built from tokens that merging
can reach. NULL text counts as empty: no tokens. Whole texts only; a piece of any length is linear work.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from courtside.llm.texts import add_from_text

#: Distinct pieces whose ids a task remembers; only speed depends on it.
REMEMBERED_PIECES = 200_000
REMEMBERED_PAIRS = 1_000_000


def parse_ranks(content: bytes) -> dict[bytes, int]:
    """A rank file: one line per token, base64 and rank."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}


class Merges:
    """The vocabulary with, for each token, the two parts its last merge joined."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values(), default=-1) + 1
        self.bytes_of: list[bytes] = [b""] * size
        self.left, self.right = list(range(size)), list(range(size))
        self.joined: dict[tuple[int, int], int] = {}
        self._apart: dict[tuple[int, int], bool] = {}
        reachable: dict[bytes, int] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            self.bytes_of[rank] = token
            if len(token) == 1:
                reachable[token] = rank
                continue
            for cut in range(1, len(token)):
                a, b = reachable.get(token[:cut]), reachable.get(token[cut:])
                if a is not None and b is not None and (a, b) not in self.joined and self._stay_apart(a, b):
                    self.left[rank], self.right[rank] = a, b
                    self.joined[a, b] = rank
                    reachable[token] = rank
                    break
        self.reachable = reachable
        #: every ending of a reachable token: a walk backwards over bytes stops as soon as it leaves this set
        self.endings = {t[i:] for t in reachable for i in range(len(t))}
        self.longest = max(map(len, reachable), default=1)

    def _stay_apart(self, a: int, b: int) -> bool:
        """Whether merging, run over the bytes of both tokens, ends with exactly these two.

        Undo the merges of both sides from the latest one on. ``limit`` is the rank of the merge last undone: had a pair
        across the border a smaller rank, it would have been merged before.
        """
        left, right, joined = self.left, self.right, self.joined
        limit = len(self.bytes_of) + 1
        while True:
            across = joined.get((a, b))
            if across is not None and across < limit:
                return False
            a_whole, b_whole = left[a] == a, left[b] == b
            if a_whole and b_whole:
                return True
            # of two equal tokens the left one is merged first, so the right one is undone first
            if not a_whole and (b_whole or a > b):
                limit, a = a, right[a]
            else:
                limit, b = b + 1, left[b]

    def apart(self, a: int, b: int) -> bool:
        known = self._apart.get((a, b))
        if known is None:
            if len(self._apart) >= REMEMBERED_PAIRS:
                self._apart.clear()
            known = self._apart[a, b] = self._stay_apart(a, b)
        return known


class PrefixEncoder:
    """The last token of every prefix of some bytes."""

    def __init__(self, merges: Merges, data: bytes = b""):
        self.merges, self.data, self.last = merges, b"", []
        self.append(data)

    def _last_of(self, data: bytes, last: list[int], end: int) -> int:
        m = self.merges
        start = end - 1
        while start >= 0:
            part = data[start:end]
            if part not in m.endings:
                break
            token = m.reachable.get(part)
            if token is not None and (start == 0 or m.apart(last[start - 1], token)):
                return token
            start -= 1
        raise ValueError("the vocabulary lacks a single byte")

    def append(self, more: bytes) -> None:
        data, last = self.data + more, self.last
        for end in range(len(self.data) + 1, len(data) + 1):
            last.append(self._last_of(data, last, end))
        self.data = data

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Replaces bytes ``start`` to ``end``; returns how many prefixes were computed anew.

        A prefix depends on the tokens stored for the ``longest`` prefixes before it only. Once that many in a row behind
        the edit equal the old ones, all later ones do.
        """
        data = self.data[:start] + new + self.data[end:]
        old, shift = self.last, len(new) - (end - start)
        last, same, done = old[:start], 0, 0
        edited = start + len(new)
        for at in range(start + 1, len(data) + 1):
            token = self._last_of(data, last, at)
            last.append(token)
            done += 1
            before = at - shift
            clear = at - len(self.merges.bytes_of[token]) >= edited
            same = same + 1 if clear and token == old[before - 1] else 0
            if same >= self.merges.longest:
                last += old[before:]
                break
        self.data, self.last = data, last
        return done

    def ids(self) -> list[int]:
        out, at = [], len(self.last)
        while at:
            token = self.last[at - 1]
            out.append(token)
            at -= len(self.merges.bytes_of[token])
        return out[::-1]


def encode_piece(merges: Merges, piece: bytes) -> list[int]:
    whole = merges.ranks.get(piece)
    return [whole] if whole is not None else PrefixEncoder(merges, piece).ids()


class _Pieces(dict):
    """Packed ids of a piece, made when first asked for."""

    def __init__(self, merges: Merges):
        super().__init__()
        self.merges = merges

    def __missing__(self, piece: str) -> bytes:
        ids = encode_piece(self.merges, piece.encode("utf-8"))
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= 64:
            if len(self) >= REMEMBERED_PIECES:
                self.clear()
            self[piece] = packed
        return packed


@lru_cache(maxsize=2)
def _tables(digest: str, content: bytes) -> tuple[Merges, _Pieces]:
    merges = Merges(parse_ranks(content))
    return merges, _Pieces(merges)


class _Content:
    """A rank file's bytes, hashed once so that tasks of one worker share its tables."""

    def __init__(self, content: bytes):
        self.content, self.digest = content, hashlib.sha256(content).hexdigest()


ENCODED = T.StructType([
    T.StructField("n_tokens", T.LongType(), False),
    T.StructField("ids", T.BinaryType(), False),
    T.StructField("decoded", T.BinaryType(), False),
])


def _vocabulary(spark: SparkSession, path: str):
    # a vocabulary file has a fixed size of about a megabyte, whatever the documents are
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(_Content(f.read()))


def unpacked(packed: bytes) -> list[int]:
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", into: str = "encoded", keep: list[str] | None = None) -> DataFrame:
    """``df`` with a struct: ``n_tokens``, ``ids`` (little-endian unsigned 32-bit) and ``decoded``, the bytes the ids stand for.

    ``path`` is the rank file on the driver, ``pattern`` splits a text into the pieces that are encoded one by one.
    """
    shared = _vocabulary(df.sparkSession, path)

    def make():
        import numpy as np
        import regex

        merges, pieces = _tables(shared.value.digest, shared.value.content)
        split, bytes_of = regex.compile(pattern).findall, merges.bytes_of

        def work(texts: list[str]) -> list[list]:
            counts, packed, decoded = [], [], []
            for t in texts:
                ids = b"".join(map(pieces.__getitem__, split(t)))
                counts.append(len(ids) // 4)
                packed.append(ids)
                decoded.append(b"".join(map(bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())))
            return [counts, packed, decoded]

        return work

    return add_from_text(df, text, make, into, ENCODED, keep)
