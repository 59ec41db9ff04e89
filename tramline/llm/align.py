"""Alignment of two tokenizers' tokens over the same bytes.

Both tokenizers encode a space and the text. In each Arrow batch the tokens' byte ranges form
two pandas frames; ``merge_asof``, keyed by document, finds for each token start the other
side's token that covers it. The union of both directions is all overlapping pairs. Byte
offsets where tokens of both sides end cut the tokens into groups.

A group's links are all its pairs: the overlapping ones, and those of groups with several
tokens on both sides that don't touch. Links are summed up per document and id pair at once;
how many documents hold an id pair is then counted over the corpus, and each document adds up
the counts of its own pairs.

Between two non-blank characters a single space starts a new token on both sides (checked for
the vocabularies at hand), so texts are encoded piece by piece, and pieces are remembered in
a bounded memo.

Null and empty texts, and texts whose tokens don't spell them on one side (those with U+2581
in them), have no tokens: all counts are zero and the groups are the empty string. Repeated
rows are documents of their own.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import chain
from operator import itemgetter

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import carried, field, map_texts, stored

BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"
# The tokenizers' files travel to every executor; larger ones are refused.
MAX_MODEL_BYTES = 64 << 20
# Text pieces remembered per Python worker, in each of two generations (about 400 bytes
# each), and how long they may be. A speed-up alone: results don't depend on it.
MEMO_ENTRIES = 1 << 18
MEMO_CHARS = 48
# Characters of text aligned at once; a longer text is aligned by itself.
FRAME_CHARS = 1 << 20
# Pairs of a group that are listed one by one; those of larger groups are counted by ids.
MAX_GROUP_PAIRS = 4096
# Id pairs whose counts may be broadcast (about 60 bytes each in an executor); more are joined by shuffle.
MAX_BROADCAST_PAIRS = 4_000_000

#: A single space between characters that neither Python nor a tokenizer takes for a blank.
_CUT = re.compile(r"(?<=[^\s\u180e]) (?=[^\s\u180e])")
# The end of the Latin, Greek and Cyrillic blocks, whose letters have long been settled.
LAST_PLAIN = "\u052f"
_PAIR = np.dtype([("id", "<i4"), ("end", "<i4")])


def byte_alphabet() -> dict[str, int]:
    """Characters that byte-level vocabularies write bytes with: printable Latin-1 stands for
    itself, the other bytes in order for the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Sides:
    """Both tokenizers: ids and byte ends of a piece of text with a space before it."""

    def __init__(self, vocabulary: bytes, model: bytes) -> None:
        import os

        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_str(vocabulary.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        letters = byte_alphabet()
        vocab = {i: _letters(t, letters) for t, i in self.a.get_vocab().items()}
        self.a_bytes = [vocab.get(i, b"") for i in range(max(vocab) + 1)]
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        made = json.loads(vocabulary)
        self.cuts = self._cuttable(made)
        self.ranked = self._ranked(made) if self.cuts else None
        self.line_end = self.a_bytes.index(b"\n")
        self.memo: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def _cuttable(self, made: dict) -> bool:
        """Whether no token of either side goes on from a non-blank to a space."""
        split = made["pre_tokenizer"] or {}
        words = made["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        return bool(words) and not any(re.search("[^▁]▁", self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))

    def _ranked(self, made: dict):
        """The byte-level vocabulary for merging by id; None if its ids don't follow its merges."""
        import tiktoken

        ids, merges = made["model"]["vocab"], made["model"]["merges"]
        first = len(byte_alphabet())
        joined = ("".join(m if isinstance(m, list) else m.split(" ")) for m in merges)
        if len(ids) != first + len(merges) or any(ids.get(t) != first + k for k, t in enumerate(joined)):
            return None
        return tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                 mergeable_ranks={self.a_bytes[i]: i for i in ids.values()})

    def pieces(self, text: str) -> list[str]:
        return _CUT.split(text) if self.cuts else [text]

    def encode(self, pieces: list[str]) -> list[tuple]:
        """(ids and ends of A, of B, count of A, of B, bytes, whether both spell the piece) per piece.

        Bytes count the space before the piece.
        """
        out = list(map(self.memo.get, pieces))
        open_ = [i for i, e in enumerate(out) if e is None]
        if open_:
            asked = {pieces[i] for i in open_}
            found = {p: self.older[p] for p in asked if p in self.older}
            new = [p for p in asked if p not in found]
            found.update(zip(new, self._encoded(new), strict=True))
            for i in open_:
                out[i] = found[pieces[i]]
            if len(self.memo) > MEMO_ENTRIES:
                self.older, self.memo = self.memo, {}
            self.memo.update((p, e) for p, e in found.items() if len(p) <= MEMO_CHARS)
        return out

    def _encoded(self, pieces: list[str]) -> Iterator[tuple]:
        for k in range(0, len(pieces), 4096):
            some = pieces[k:k + 4096]
            data = [b" " + p.encode() for p in some]
            of_a = self._byte_level(some)
            left, right = _packed(of_a, self.a_bytes, data), _packed(self.b.encode(some, num_threads=1), self.b_bytes, data)
            for d, (a, n_a, a_ok), (b, n_b, b_ok) in zip(data, left, right, strict=True):
                yield a, b, n_a, n_b, len(d), a_ok and b_ok


    def _byte_level(self, pieces: list[str]) -> list[list[int]]:
        """A's ids. Where the vocabulary's ids are in the order of its merges, merging by id is
        merging by rule, and tiktoken does that in a quarter of the time; pieces with letters
        that the libraries' Unicode tables might disagree on go to the vocabulary's own library."""
        if self.ranked is None:
            return [x.ids for x in self.a.encode_batch([" " + p for p in pieces], add_special_tokens=False)]
        out: list = [None] * len(pieces)
        plain = [i for i, p in enumerate(pieces) if p and max(p) <= LAST_PLAIN]
        # Pieces without blanks are encoded in one go: a line end between two is a token of its own.
        solid = [i for i in plain if pieces[i].split() == [pieces[i]]]
        ids = self.ranked.encode_ordinary("".join([f" {pieces[i]}\n" for i in solid]))
        at = 0
        for i in solid:
            end = ids.index(self.line_end, at)
            out[i] = ids[at:end]
            at = end + 1
        for i in plain:
            if out[i] is None:
                out[i] = self.ranked.encode_ordinary(" " + pieces[i])
        rest = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(rest, self.a.encode_batch([" " + pieces[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = x.ids
        return out


def _letters(token: str, letters: dict[str, int]) -> bytes:
    return bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()


def _packed(ids: list[list[int]], table: list[bytes], data: list[bytes]) -> list[tuple[bytes, int, bool]]:
    """(ids and ends as bytes, number of ids, whether they spell the data) per list of ids."""
    counts = list(map(len, ids))
    flat = list(chain.from_iterable(ids))
    spelled = list(map(table.__getitem__, flat))
    stops = np.cumsum(counts)
    starts = stops - counts
    total = np.concatenate(([0], np.cumsum(np.array(list(map(len, spelled)), np.int64))))
    out = np.empty(len(flat), _PAIR)
    out["id"] = flat
    out["end"] = total[1:] - np.repeat(total[starts], counts)
    # All lists at once; one by one only where something differs.
    same = b"".join(spelled) == b"".join(data) and np.array_equal(total[stops] - total[starts], list(map(len, data)))
    whole, width = out.tobytes(), _PAIR.itemsize
    return [(whole[width * i:width * j], j - i, same or b"".join(spelled[i:j]) == d)
            for i, j, d in zip(starts.tolist(), stops.tolist(), data, strict=True)]


def read_models(byte_path: str | None = None, piece_path: str | None = None) -> tuple[bytes, bytes]:
    """The tokenizers' files, which go to the executors as they are."""
    paths = byte_path or public_tokenizers.path(BYTE_VOCABULARY), piece_path or public_tokenizers.path(PIECE_MODEL)
    found = []
    for path in paths:
        with open(path, "rb") as f:
            found.append(f.read(MAX_MODEL_BYTES + 1))
        if len(found[-1]) > MAX_MODEL_BYTES:
            raise ValueError(f"{path}: more than {MAX_MODEL_BYTES} bytes")
    return found[0], found[1]


@lru_cache(maxsize=2)
def sides(models: tuple[bytes, bytes]) -> Sides:
    """The tokenizers, made once per process."""
    return Sides(*models)


def side_frame(packed: Sequence[bytes], counts: Sequence[int], docs: np.ndarray,
               offsets: np.ndarray) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """One side's tokens as a frame (doc, start, token), with their ends and ids.

    ``docs`` has the document of each piece, ``offsets`` the place of its first byte among all.
    """
    flat = np.frombuffer(b"".join(packed), _PAIR)
    doc = np.repeat(docs, counts)
    end = np.repeat(offsets, counts) + flat["end"]
    # Pieces follow each other without gaps, and so do tokens.
    start = np.concatenate((offsets[:1], end[:-1])) if len(end) else end
    return pd.DataFrame({"doc": doc, "start": start, "token": np.arange(len(end))}), end, flat["id"].astype(np.int64)


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of tokens of one document whose byte ranges overlap.

    Each token start is covered by one token of the other side; a pair whose tokens
    start together is found from both sides and taken once.
    """
    onto_b = pd.merge_asof(a, b, on="start", by="doc", suffixes=("_a", "_b"))
    starts = a["start"].to_numpy()
    at = np.minimum(np.searchsorted(starts, b["start"].to_numpy()), len(starts) - 1)
    onto_a = pd.merge_asof(b[starts[at] != b["start"].to_numpy()], a, on="start", by="doc", suffixes=("_b", "_a"))
    return (np.concatenate([onto_b["token_a"].to_numpy(), onto_a["token_a"].to_numpy(np.int64)]),
            np.concatenate([onto_b["token_b"].to_numpy(np.int64), onto_a["token_b"].to_numpy()]))


def apart(group_a: np.ndarray, group_b: np.ndarray, n_groups: int, range_a: np.ndarray,
          range_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Links of groups with two tokens or more on both sides that ``overlaps`` doesn't have.

    ``range_a`` and ``range_b`` have the tokens' starts and ends. Groups of more than
    ``MAX_GROUP_PAIRS`` pairs are returned by number instead.
    """
    n_a, n_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
    many = (n_a > 1) & (n_b > 1)
    large = n_a * n_b > MAX_GROUP_PAIRS
    some = np.flatnonzero(many & ~large)
    first_a, first_b = (np.cumsum(n_a) - n_a)[some], (np.cumsum(n_b) - n_b)[some]
    width, pairs = n_b[some], n_a[some] * n_b[some]
    at = np.arange(pairs.sum()) - np.repeat(np.cumsum(pairs) - pairs, pairs)
    i = np.repeat(first_a, pairs) + at // np.repeat(width, pairs)
    j = np.repeat(first_b, pairs) + at % np.repeat(width, pairs)
    off = (range_a[0][i] >= range_b[1][j]) | (range_b[0][j] >= range_a[1][i])
    return i[off], j[off], np.flatnonzero(many & large).tolist()


def _large_group(ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs of a group's tokens, counted by ids: (ids of A, ids of B, times)."""
    xs, nx = np.unique(ids_a, return_counts=True)
    ys, ny = np.unique(ids_b, return_counts=True)
    return np.repeat(xs, len(ys)), np.tile(ys, len(xs)), np.outer(nx, ny).ravel()


def align_texts(texts: list[str], tools: Sides) -> list[tuple]:
    """``_aligned`` without the collector of reference cycles, which would walk the memo's tuples
    again and again; nothing here makes cycles."""
    was_on = gc.isenabled()
    gc.disable()
    try:
        return _aligned(texts, tools)
    finally:
        if was_on:
            gc.enable()


def _aligned(texts: list[str], tools: Sides) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, groups, id pairs, times) per text; pairs are a * size of B + b."""
    size_b = len(tools.b_bytes)
    split = [tools.pieces(t) if t else [] for t in texts]
    encoded = tools.encode(list(chain.from_iterable(split)))
    of_piece = np.repeat(np.arange(len(texts)), list(map(len, split)))
    if not all(map(itemgetter(5), encoded)):
        # Documents that a side doesn't spell have no tokens.
        bad = np.zeros(len(texts), bool)
        bad[of_piece[[not e[5] for e in encoded]]] = True
        keep = ~bad[of_piece]
        encoded, of_piece = [e for e, k in zip(encoded, keep.tolist(), strict=True) if k], of_piece[keep]
    none = (0, 0, 0, 0, "", [], [])
    if not encoded:
        return [none] * len(texts)
    columns = list(zip(*encoded, strict=True))
    sizes = np.array(columns[4], np.int64)
    offsets = np.cumsum(sizes) - sizes
    a, end_a, ids_a = side_frame(columns[0], columns[2], of_piece, offsets)
    b, end_b, ids_b = side_frame(columns[1], columns[3], of_piece, offsets)
    pair_a, pair_b = overlaps(a, b)
    ends = np.intersect1d(end_a, end_b, assume_unique=True)
    group_a, group_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
    doc_a, doc_b = a["doc"].to_numpy(), b["doc"].to_numpy()
    group_doc = np.empty(len(ends), np.int64)
    group_doc[group_a] = doc_a
    span = len(tools.a_bytes) * size_b
    off_a, off_b, large = apart(group_a, group_b, len(ends), np.stack([a["start"].to_numpy(), end_a]), np.stack([b["start"].to_numpy(), end_b]))
    if large:  # their overlapping pairs are among all their pairs
        small = ~np.isin(group_a[pair_a], large)
        pair_a, pair_b = pair_a[small], pair_b[small]
    keys = [doc_a[i] * span + ids_a[i] * size_b + ids_b[j] for i, j in ((pair_a, pair_b), (off_a, off_b))]
    distinct, total = np.unique(np.concatenate(keys), return_counts=True)
    for g in large:
        x, y, times = _large_group(ids_a[group_a == g], ids_b[group_b == g])
        distinct, where = np.unique(np.concatenate([distinct, group_doc[g] * span + x * size_b + y]), return_inverse=True)
        total = np.bincount(where, np.concatenate([total, times]), len(distinct)).astype(np.int64)
    n = len(texts)
    n_a, n_b, n_g = (np.bincount(x, minlength=n).tolist() for x in (doc_a, doc_b, group_doc))
    bounds = np.searchsorted(distinct, np.arange(n + 1) * span).tolist()
    codes = distinct % span
    spelled = _spelled(ids_a, ids_b, group_a, group_b, len(ends))
    out, first = [], 0
    for d in range(n):
        if not n_a[d]:
            out.append(none)
            continue
        lo, hi = bounds[d], bounds[d + 1]
        last = first + n_a[d] + n_b[d]
        out.append((n_a[d], n_b[d], n_g[d], int(total[lo:hi].sum()), "".join(spelled[first:last])[:-1], codes[lo:hi], total[lo:hi]))
        first = last
    return out


def _spelled(ids_a: np.ndarray, ids_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, n_groups: int) -> list[str]:
    """Every id with the mark behind it, group by group, A before B."""
    n_a, n_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
    before_a, before_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    out = np.empty(len(ids_a) + len(ids_b), object)
    for ids, group, at, mark in ((ids_a, group_a, np.arange(len(ids_a)) + before_b[group_a], "|"),
                                 (ids_b, group_b, np.arange(len(ids_b)) + (before_a + n_a)[group_b], ";")):
        size = 1 << int(ids.max()).bit_length()
        ends_group = np.concatenate((group[1:] != group[:-1], [True]))
        out[at] = _marked(size, mark)[ids + ends_group * size]
    return out.tolist()


@lru_cache(maxsize=64)
def _marked(size: int, mark: str) -> np.ndarray:
    """Numbers below ``size`` as text with a comma, then with the mark behind them."""
    return np.array([f"{i}{m}" for m in (",", mark) for i in range(size)], object)


def align(docs: DataFrame, text_col: str = "text", models: tuple[bytes, bytes] | None = None) -> DataFrame:
    """``docs`` with n_a, n_b, n_groups, n_links, groups_sha256, pairs and times.

    ``pairs`` has the document's linked id pairs (a * size of B + b) and ``times`` how often
    each is linked. Columns with these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models or read_models())

    def start() -> Callable[[pa.Array], list[pa.Array]]:
        tools = sides(shared.value)

        def batch(texts: pa.Array) -> list[pa.Array]:
            rows: list[tuple] = []
            some: list[str] = []
            size = 0
            for text in texts.to_pylist():
                if some and size + len(text or "") > FRAME_CHARS:
                    rows += _summed(align_texts(some, tools))
                    some, size = [], 0
                some.append(text or "")
                size += len(some[-1])
            rows += _summed(align_texts(some, tools))
            numbers = [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)]
            return [*numbers, pa.array([r[4] for r in rows]), *(_lists([r[k] for r in rows], t) for k, t in ((5, pa.int64()), (6, pa.int32())))]

        return batch

    added = [field(c, "long") for c in ("n_a", "n_b", "n_groups", "n_links")]
    added += [field("groups_sha256", "string"), field("pairs", "array<long>"), field("times", "array<int>")]
    return map_texts(docs, text_col, added, start)


def _summed(rows: list[tuple]) -> list[tuple]:
    return [(*r[:4], hashlib.sha256(r[4].encode()).hexdigest() if r[0] else "", *r[5:]) for r in rows]


def _lists(rows: list, kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0] + [len(x) for x in rows])
    flat = np.concatenate([np.asarray(x, np.int64) for x in rows]) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat).cast(kind))


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(pair, docs, best): in how many rows each id pair is linked, and whether no pair with
    its A id has more."""
    counts = stored(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("docs")), "pair-counts")
    a = F.floor(F.col("pair") / size_b).alias("a")
    most = counts.groupBy(a).agg(F.max("docs").alias("most"))
    return counts.withColumn("a", a).join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def scored(docs: DataFrame, text_col: str = "text", models: tuple[bytes, bytes] | None = None,
           max_broadcast_pairs: int = MAX_BROADCAST_PAIRS) -> DataFrame:
    """``align`` with n_best and count_sum in place of pairs and times.

    n_best: links whose pair has its A id's highest count over all rows, ties included.
    count_sum: the pairs' counts, summed over the links.
    """
    models = models or read_models()
    size_b = len(sides(models).b_bytes)
    slim = carried(docs, text_col)
    own = stored(align(slim, text_col, models).drop(text_col).withColumn("__at__", F.monotonically_increasing_id()), "aligned")
    counts = stored(pair_counts(own, size_b), "pair-best")
    if counts.count() <= max_broadcast_pairs:
        counts = F.broadcast(counts)
    each = own.select("__at__", F.explode(F.arrays_zip("pairs", "times")).alias("l"))
    sums = (each.select("__at__", F.col("l.pairs").alias("pair"), F.col("l.times").cast("long").alias("times")).join(counts, "pair")
            .groupBy("__at__").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                   F.sum(F.col("times") * F.col("docs")).alias("count_sum")))
    zero = F.lit(0).cast("long")
    found = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    kept = [c for c in docs.columns if c != text_col and c.lower() not in {*found, "n_best", "count_sum"}]
    return own.join(sums, "__at__", "left").select(
        *[F.col("__row__")[c].alias(c) for c in kept], *found, F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"))
