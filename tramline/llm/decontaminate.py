"""Benchmark decontamination with a generalised suffix automaton.

The test items' normalised words form one suffix automaton per bounded shard of
items, each built in a task. Documents stream through it word by word; the automaton's state keeps the
longest suffix read so far that occurs in some item. Where that length reaches
the window (13 words) an item window ends; an item shorter than a window must
occur whole. Words inside any such occurrence are hit.

``decontaminate`` then removes: a document whose hit words reach the coverage
limit goes, and in the others every maximal run of hit words that exceeds the
length limit is cut out of the text.

Nulls and texts without words have no words, no hits and are never contaminated;
items without words match nothing. Repeated items (same item id) count once.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import carried, field, keep_columns, map_texts, restored, stored

WINDOW = 13
# A document is contaminated if its hit words are at least 1/20 of its words.
COVERAGE = (1, 20)
# Item words in one automaton (about 1 kB of Python objects per word); larger item
# tables are split over several automata.
SHARD_WORDS = 100_000

#: Fixed: bytes that belong to words (digits, letters, everything outside ASCII), A-Z lower-cased; the rest become spaces.
_WORD_BYTES = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256))
_RUN = re.compile(rb"[^ ]+")


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_WORD_BYTES).split() if text else []


class Automaton:
    """Generalised suffix automaton over word sequences of items.

    ``vocabulary`` numbers the items' words from 1 (0: any other word). State 0 is
    the root. ``window_of[state]`` is the state that stands for the state's suffix
    of ``window`` words (-1: shorter), ``items_at`` has the items that contain it;
    ``short_at`` lists (length, items) of whole items below the window that are
    suffixes of the state's longest string.
    """

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        encoded = []
        for item, words in items:
            if words:
                numbers = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
                encoded.append((item, numbers))
                last = 0
                for x in numbers:
                    last = self._extend(last, x)
        self.least = min([window, *(len(x) for _, x in encoded)])
        order = sorted(range(len(self.link)), key=self.length.__getitem__)
        self.window_of = [-1] * len(order)
        for s in order[1:]:
            up = self.link[s]
            self.window_of[s] = self.window_of[up] if self.length[up] >= window else (
                s if self.length[s] >= window else -1)
        self.items_at: dict[int, set[str]] = {}
        short: dict[int, dict[int, set[str]]] = {}
        for item, numbers in encoded:
            state = 0
            for x in numbers:
                state = self.next[state][x]
                if (at := self.window_of[state]) >= 0:
                    self.items_at.setdefault(at, set()).add(item)
            if len(numbers) < window:
                short.setdefault(state, {}).setdefault(len(numbers), set()).add(item)
        self.short_at: list[tuple[tuple[int, frozenset[str]], ...]] = [()] * len(order)
        for s in order[1:]:
            own = tuple((n, frozenset(x)) for n, x in sorted(short.get(s, {}).items(), reverse=True))
            self.short_at[s] = own + self.short_at[self.link[s]]

    def _extend(self, last: int, x: int) -> int:
        """The state of the string of ``last`` followed by ``x``, made if need be."""
        new = self.next[last].get(x)
        if new is not None and self.length[new] == self.length[last] + 1:
            return new
        if new is not None:
            return self._split(last, x, new)
        cur = self._state({}, self.length[last] + 1)
        at = last
        while at >= 0 and x not in self.next[at]:
            self.next[at][x] = cur
            at = self.link[at]
        if at < 0:
            self.link[cur] = 0
        else:
            to = self.next[at][x]
            self.link[cur] = to if self.length[to] == self.length[at] + 1 else self._split(at, x, to)
        return cur

    def _state(self, edges: dict[int, int], length: int) -> int:
        self.next.append(edges)
        self.link.append(-1)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, at: int, x: int, to: int) -> int:
        """Separate the strings of ``to`` no longer than that of ``at`` plus ``x``."""
        clone = self._state(dict(self.next[to]), self.length[at] + 1)
        self.link[clone] = self.link[to]
        self.link[to] = clone
        while at >= 0 and self.next[at].get(x) == to:
            self.next[at][x] = clone
            at = self.link[at]
        return clone

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Occurrences as (first word, word after the last), and the items found."""
        n = len(words)
        if n < self.least:
            return [], set()
        get = self.vocabulary.get
        numbers = np.fromiter((get(w, 0) for w in words), np.int32, n)
        # Only runs of item words that are as long as the shortest window can match.
        edges = np.flatnonzero(np.diff(np.concatenate(([0], numbers != 0, [0])).astype(np.int8)))
        starts, stops = edges[::2], edges[1::2]
        enough = stops - starts >= self.least
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        for a, b in zip(starts[enough].tolist(), stops[enough].tolist(), strict=True):
            self._stream(numbers[a:b].tolist(), a, spans, found)
        return spans, found

    def _stream(self, numbers: list[int], at: int, spans: list[tuple[int, int]], found: set[str]) -> None:
        nxt, link, length, window, least = self.next, self.link, self.length, self.window, self.least
        state = matched = 0
        for x in numbers:
            at += 1
            to = nxt[state].get(x)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = nxt[state].get(x)
            if to is None:
                continue
            state, matched = to, matched + 1
            if matched < least:
                continue
            if matched >= window:
                spans.append((at - window, at))
                found |= self.items_at[self.window_of[state]]
            for n, items in self.short_at[state]:
                if matched >= n:
                    spans.append((at - n, at))
                    found |= items


def automata(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW,
             shard_words: int = SHARD_WORDS) -> tuple[DataFrame, int]:
    """(shard, automaton) rows, and the number of shards.

    Items are dealt to shards of about ``shard_words`` words by a hash, and every automaton is
    built in a task of its own, pickled and stored. An item longer than a shard is cut into pieces that
    overlap by window - 1 words, so that every window stays whole. Null ids are named "null".
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                for a in range(0, len(words) - window + 1 if len(words) > window else min(1, len(words)), shard_words):
                    piece = words[a:a + shard_words + window - 1]
                    rows.append((item, a, b" ".join(piece), len(piece)))
            columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                columns, (pa.string(), pa.int64(), pa.binary(), pa.int64()), strict=True)], names=["item", "at", "words", "n"])

    def build(table: pa.Table) -> pa.Table:
        items = [(i, w.split()) for i, w in zip(table.column("item").to_pylist(), table.column("words").to_pylist(), strict=True)]
        made = pickle.dumps(Automaton(sorted(items), window), pickle.HIGHEST_PROTOCOL)
        return pa.table({"shard": pa.array([table.column("shard")[0].as_py()], pa.int32()), "automaton": pa.array([made], pa.binary())})

    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), F.col(text_col).alias("text"))
    pieces = stored(items.mapInArrow(cut, "item string, at long, words binary, n long"), "benchmark-pieces")
    total = pieces.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n = max(1, -(-total // shard_words))
    shard = F.pmod(F.xxhash64("item", "at"), F.lit(n)).cast("int")
    built = pieces.select(shard.alias("shard"), "item", "words").groupBy("shard").applyInArrow(build, "shard int, automaton binary")
    return stored(built, "automata"), n


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching word ranges joined, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def _lists(rows: list[list], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0] + [len(x) for x in rows])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                    pa.array([x for row in rows for x in row], kind))


def match(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW,
          shard_words: int = SHARD_WORDS, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with n_words, hit_starts, hit_stops (merged word ranges) and item_ids.

    One automaton, bounded by ``shard_words``, is broadcast per pass over the documents, and is
    all that a task holds. With one shard that is the whole job, and the result is lazy. With more,
    the rows are stored once, every pass stores the rows that its shard hits, and these few
    are merged by row.
    """
    kept = keep_columns(docs, list(_ADDED))
    built, n = automata(benchmark, item_id, item_text, window, shard_words)
    if n == 1:
        return _match_shard(docs.select(*kept), _automaton(built, 0, window), text_col).select(*kept, *_ADDED)
    rows = stored(carried(docs.select(*kept), text_col).withColumn("__at__", F.monotonically_increasing_id()), "decontaminate-rows")
    spark, passes = docs.sparkSession, []
    for k in range(n):
        shared = spark.sparkContext.broadcast(_automaton(built, k, window))
        hits = _match_shard(rows.select("__at__", text_col), shared, text_col).filter(F.size("item_ids") > 0)
        passes.append(stored(hits.select("__at__", F.arrays_zip("hit_starts", "hit_stops").alias("spans"), "item_ids"), f"hits-{k}"))
        shared.unpersist()
    spans = F.array_sort(F.flatten(F.collect_list("spans")))  # one list per shard and row
    every = reduce(DataFrame.union, passes).groupBy("__at__").agg(
        spans.alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"))
    whole = _with_counts(rows, text_col).join(_merged(every), "__at__", "left")
    none = {"hit_starts": "array<int>", "hit_stops": "array<int>", "item_ids": "array<string>"}
    found = [F.coalesce(c, F.array().cast(t)).alias(c) for c, t in none.items()]
    return whole.select(*[F.col(c) if c == text_col else F.col("__row__")[c].alias(c) for c in kept], "n_words", *found)


_ADDED = ("n_words", "hit_starts", "hit_stops", "item_ids")


def _automaton(built: DataFrame, shard: int, window: int) -> bytes:
    """A shard's pickled automaton; an empty one where the hash left the shard without items."""
    row = built.filter(F.col("shard") == shard).select("automaton").first()
    return bytes(row[0]) if row else pickle.dumps(Automaton([], window))


def _with_counts(rows: DataFrame, text_col: str) -> DataFrame:
    def start():
        return lambda texts: [pa.array([len(words_of(t)) for t in texts.to_pylist()], pa.int64())]

    return map_texts(rows, text_col, [field("n_words", "long")], start)


def _merged(rows: DataFrame) -> DataFrame:
    """Spans in order (array of struct) as merged ranges."""
    def start():
        def batch(lists: pa.Array) -> list[pa.Array]:
            merged = [merge_spans([(s["hit_starts"], s["hit_stops"]) for s in x]) for x in lists.to_pylist()]
            return [_lists([[a for a, _ in x] for x in merged], pa.int32()), _lists([[b for _, b in x] for x in merged], pa.int32())]

        return batch

    return map_texts(rows, "spans", [field("hit_starts", "array<int>"), field("hit_stops", "array<int>")], start).drop("spans")


def _match_shard(docs: DataFrame, automaton: bytes | Broadcast, text_col: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(automaton) if isinstance(automaton, bytes) else automaton

    def start():
        scan = pickle.loads(shared.value).scan

        def batch(values: pa.Array) -> list[pa.Array]:
            counts, starts, stops, items = [], [], [], []
            for text in values.to_pylist():
                words = words_of(text)
                spans, found = scan(words)
                spans = merge_spans(spans)
                counts.append(len(words))
                starts.append([a for a, _ in spans])
                stops.append([b for _, b in spans])
                items.append(sorted(found))
            return [pa.array(counts, pa.int64()), _lists(starts, pa.int32()), _lists(stops, pa.int32()),
                    _lists(items, pa.string())]

        return batch

    added = [field("n_words", "long"), field("hit_starts", "array<int>"), field("hit_stops", "array<int>"),
             field("item_ids", "array<string>")]
    return map_texts(docs, text_col, added, start)


def judged(matched: DataFrame, coverage: tuple[int, int] = COVERAGE) -> DataFrame:
    """Add n_hit (long) and contaminated: n_hit > 0 and its share reaches ``coverage``."""
    n_hit = F.aggregate(F.zip_with("hit_starts", "hit_stops", lambda a, b: (b - a).cast("long")),
                        F.lit(0).cast("long"), lambda x, y: x + y)
    part, whole = coverage
    return matched.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (whole * F.col("n_hit") >= part * F.col("n_words")))


def cut_words(text: str, ranges: list[tuple[int, int]]) -> str:
    """``text`` without the given ranges of its words and the characters between them."""
    data = text.encode()
    at = [m.span() for m in _RUN.finditer(data.translate(_WORD_BYTES))]
    out, left = [], 0
    for a, b in ranges:
        out.append(data[left:at[a][0]])
        left = at[b - 1][1]
    return b"".join([*out, data[left:]]).decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW,
                  coverage: tuple[int, int] = COVERAGE, max_span: int = WINDOW - 1,
                  shard_words: int = SHARD_WORDS) -> DataFrame:
    """Documents under the coverage limit, without their hit runs of over ``max_span`` words.

    Keeps the columns of ``docs``; texts without such runs stay as they are.
    """
    found = judged(match(carried(docs, text_col), benchmark, text_col, window, shard_words), coverage)
    clean = found.filter(~F.col("contaminated")).withColumn(
        "__cut__", F.struct(F.col(text_col).alias("text"), "hit_starts", "hit_stops"))

    def start():
        def batch(values: pa.Array) -> list[pa.Array]:
            out = []
            for x in values.to_pylist():
                ranges = [(a, b) for a, b in zip(x["hit_starts"], x["hit_stops"], strict=True) if b - a > max_span]
                out.append(cut_words(x["text"], ranges) if ranges else x["text"])
            return [pa.array(out, pa.string())]

        return batch

    cut = map_texts(clean.drop(text_col), "__cut__", [field(text_col, "string")], start)
    return restored(cut, docs, text_col)


def contract_rows(matched: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Digest columns per document: counts, the sorted item ids' digest, the verdict."""
    return judged(matched).select(
        id_col, "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("item_ids"), ","), 256).alias("items_sha256"), "contaminated")

