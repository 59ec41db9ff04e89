"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier 1 is a minimal perfect hash over the vocabulary: a pre-token that is itself
a vocabulary entry resolves to its rank with one probe per level and one byte
comparison. Tier 2 handles the misses: the pre-token's bytes form a linked list
and a heap of adjacent pairs, ordered by (rank, position), drives the merges.

Texts are split by the tokenizer's pattern; each match is encoded separately.
A null text is the empty text (no tokens); every byte string decodes back exactly.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from tramline.llm.common import field, map_texts

RANKS = "byte_bpe_50k.tiktoken"
# The vocabulary travels to every executor; larger files are refused.
MAX_VOCABULARY = 1_000_000
# Short pre-tokens remembered per Python worker, in each of two generations (about
# 200 bytes each), and how short they are. A speed-up alone: results don't depend on it.
MEMO_ENTRIES = 1 << 18
MEMO_CHARS = 48


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(k): int(v) for k, v in (x.split() for x in lines if x.strip())}
    if len(ranks) > MAX_VOCABULARY:
        raise ValueError(f"{path}: {len(ranks)} entries, more than {MAX_VOCABULARY}")
    return ranks


class PerfectHash:
    """Minimal perfect hash: keys that collide on one level move to the next.

    Each level is a table of ``gamma`` slots per remaining key; a key alone in
    its slot is placed there and gets the next free number, so n keys get the
    numbers 0..n-1. ``find`` answers -1 for strings that are not keys.
    """

    def __init__(self, keys: list[bytes], gamma: float = 2.0) -> None:
        self.levels: list[tuple[int, int, list[int]]] = []
        self.keys: list[bytes] = []
        left = list(dict.fromkeys(keys))
        while left:
            size = max(1, int(gamma * len(left)))
            seed = len(self.levels)
            slot = np.fromiter((xxhash.xxh3_64_intdigest(k, seed) % size for k in left),
                               np.int64, len(left))
            alone = np.bincount(slot, minlength=size)[slot] == 1
            number = np.full(size, -1, np.int32)
            number[slot[alone]] = len(self.keys) + np.arange(int(alone.sum()))
            self.levels.append((seed, size, number.tolist()))
            self.keys += [k for k, a in zip(left, alone, strict=True) if a]
            left = [k for k, a in zip(left, alone, strict=True) if not a]

    def find(self, key: bytes) -> int:
        for seed, size, number in self.levels:
            at = number[xxhash.xxh3_64_intdigest(key, seed) % size]
            if at >= 0:
                return at if self.keys[at] == key else -1
        return -1


class Codec:
    """Encoder and decoder for one vocabulary and one splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.pattern = pattern
        self.cuts_at_spaces = pattern == public_tokenizers.PATTERN
        self.ranks = ranks
        self.table = PerfectHash(list(ranks))
        self.rank = [ranks[k] for k in self.table.keys]
        self.bytes_of = {r: k for k, r in ranks.items()}

    def __getstate__(self) -> dict:
        """Without the memos that ``encoder`` keeps here."""
        return {k: v for k, v in self.__dict__.items() if k != "_memos"}

    def whole(self, piece: bytes) -> int:
        """Tier 1: the rank of a pre-token that is in the vocabulary, else -1."""
        at = self.table.find(piece)
        return self.rank[at] if at >= 0 else -1

    def merge(self, piece: bytes) -> list[int]:
        """Tier 2: merge the lowest-ranked, then leftmost pair until none is left."""
        n, rank_of = len(piece), self.ranks.get
        after = list(range(1, n + 1))  # links between the starts of parts
        before = list(range(-1, n))
        pair = [-1] * n  # rank of the part that starts here joined to the next
        heap = []
        for i in range(n - 1):
            if (r := rank_of(piece[i:i + 2])) is not None:
                pair[i] = r
                heap.append(r * n + i)
        heapq.heapify(heap)
        while heap:
            r, i = divmod(heapq.heappop(heap), n)
            if pair[i] != r:
                continue  # one of the two parts has changed since
            j = after[i]
            after[i] = k = after[j]
            before[k] = i
            pair[j] = pair[i] = -1
            if k < n and (r := rank_of(piece[i:after[k]])) is not None:
                pair[i] = r
                heapq.heappush(heap, r * n + i)
            if (h := before[i]) >= 0:
                if (r := rank_of(piece[h:k])) is not None:
                    pair[h] = r
                    heapq.heappush(heap, r * n + h)
                else:
                    pair[h] = -1
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i:after[i]]])
            i = after[i]
        return out

    def encode_piece(self, piece: bytes) -> list[int]:
        rank = self.whole(piece)
        return [rank] if rank >= 0 else self.merge(piece)


class _Memo(dict):
    """String -> its ids as little-endian 32-bit integers, in two generations."""

    def __init__(self, find) -> None:
        super().__init__()
        self.find = find
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.find(piece)
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MEMO_ENTRIES:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


#: White space (of the tokenizer's pattern) in front of a space.
_SPACE_RUN = regex.compile(r"\s ").search


def encoder(codec: Codec):
    """Text -> ids as bytes (little-endian unsigned 32-bit).

    No match of the pattern goes on from a character that isn't white space to
    one that is, so a text may be cut in front of each single space, and the
    strings between the cuts are remembered whole. Where spaces follow other white
    space the pattern runs over the whole text. The memos stay with the codec,
    which a reused worker keeps between tasks.
    """
    split = regex.compile(codec.pattern).findall
    tokens = _Memo(lambda piece: array("I", codec.encode_piece(piece.encode())).tobytes())
    find = tokens.__getitem__
    words = _Memo(lambda word: b"".join(map(find, split(f" {word}"))))
    find, words = codec.__dict__.setdefault("_memos", (find, words))

    def encode(text: str | None) -> bytes:
        if not text:
            return b""
        if not codec.cuts_at_spaces or _SPACE_RUN(text):
            return b"".join(map(find, split(text)))
        first, *rest = text.split(" ")
        return b"".join([*map(find, split(first)), *map(words.__getitem__, rest)])

    return encode


def make_codec(ranks_path: str | None = None, pattern: str | None = None) -> Codec:
    return Codec(load_ranks(ranks_path or public_tokenizers.path(RANKS)),
                 pattern or public_tokenizers.PATTERN)


def encode(docs: DataFrame, codec: Codec, text_col: str = "text",
           out_col: str = "token_ids") -> DataFrame:
    """``docs`` with ``out_col`` array<int>, the token ids of ``text_col``.

    Null and empty texts give an empty array. Rows are independent, so repeated
    rows give repeated results. A column named ``out_col`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(codec)

    def start():
        run = encoder(shared.value)

        def batch(texts: pa.Array) -> list[pa.Array]:
            ids = [run(t) for t in texts.to_pylist()]
            ends = np.cumsum([0] + [len(x) // 4 for x in ids], dtype=np.int64)
            values = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))]

        return batch

    return map_texts(docs, text_col, [field(out_col, "array<int>")], start)


def decode(docs: DataFrame, codec: Codec, ids_col: str = "token_ids",
           out_col: str = "decoded") -> DataFrame:
    """``docs`` with ``out_col`` binary, the bytes that ``ids_col`` stands for.

    A null id list decodes to no bytes; an id outside the vocabulary fails.
    """
    shared = docs.sparkSession.sparkContext.broadcast(codec.bytes_of)

    def start():
        take = shared.value.__getitem__

        def batch(ids: pa.Array) -> list[pa.Array]:
            return [pa.array([b"".join(map(take, x or ())) for x in ids.to_pylist()], pa.binary())]

        return batch

    return map_texts(docs, ids_col, [field(out_col, "binary")], start)


def digests(encoded: DataFrame, codec: Codec, ids_col: str = "token_ids") -> DataFrame:
    """Replace the ids by their count and digest and by the decoded bytes' digest."""
    shared = encoded.sparkSession.sparkContext.broadcast(codec.bytes_of)

    def start():
        take = shared.value.__getitem__

        def batch(lists: pa.Array) -> list[pa.Array]:
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            ids = [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            return [
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids]),
                pa.array([hashlib.sha256(b"".join(map(take, x.tolist()))).hexdigest() for x in ids]),
            ]

        return batch

    return map_texts(encoded, ids_col, [field("n_tokens", "long"), field("ids_sha256", "string"),
                                        field("decoded_sha256", "string")], start).drop(ids_col)
