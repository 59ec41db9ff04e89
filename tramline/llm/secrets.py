"""Secret scan with Catalyst expressions only.

Three base kinds are found by pattern: assignments, access keys and hex runs.
Beside them every candidate string (a run of token characters) is judged by the
Shannon entropy of a sliding window over its characters: each step adds the
entering character to the counts and removes the leaving one, and the sum over
c * log2(c) follows by the difference of two table values. Counts by character class
tell which class a window belongs to, the narrowest that has all of its characters: digits, hex
digits of either case, letters of one case with digits, or base64. Each has its limit.
The span from the first to the last window above its limit is reported, as of the widest
class among these windows.
Windows that hold a match of the allow list, or lie inside one, don't count; the rest
of their candidate does. The allow list never touches base kinds.

Null and empty texts have no spans. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import keep_columns

#: Base kinds in the order in which equal starts are listed.
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{14,}"  # 18 characters or more; a shorter run holds no longer one
HEX = r"[0-9a-f]{16,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
CLASSES = ("digits", "hex", "alnum", "base64")
KINDS = ("assign", "access", "hex", *(f"entropy_{c}" for c in CLASSES))
# Token characters, in runs: A-F, G-Z, a-f, g-z, digits, marks.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUNS = (6, 26, 32, 52, 62, 67)
# Matches whose positions are added up at once.
CHUNK = 256
ASSIGNED = 12

SPAN = "array<struct<start:int,stop:int,kind:string,value:string,entropy:double>>"


@dataclass(frozen=True)
class EntropyRules:
    """Window length, limit in bits for each class, and the allow list's patterns."""

    window: int = 20
    digit_bits: float = 3.15
    hex_bits: float = 3.0
    alnum_bits: float = 3.6
    base64_bits: float = 3.75
    allowed: tuple[str, ...] = field(default=(
        r"(?i)example|sample|dummy|placeholder|changeme|your[_-]?(api|key|token|secret)",
        # Words in a natural case, joined by marks, each with up to three digits behind it: prose, paths,
        # identifiers. Possessive, so that long ones need no stack.
        r"^(?:[-_/=+]*+(?:(?:[A-Z]?[a-z]{2,}+|[A-Z]{2,}+(?![a-z])|[A-Z][a-z]?(?=[A-Z][a-z]{2}|[^A-Za-z]|$))++|[A-Za-z](?![A-Za-z]))[0-9]{0,3}+(?![A-Za-z0-9]))++[-_/=+]*+$",
        r"(?i)(0123456789|abcdefghijkl|qwertyuiop)",
        r"(.)\1{7,}",
        r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",  # identifiers
    ))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _found(text: Column, pattern: str, kind: str, keep=None) -> Column:
    """Spans of the leftmost non-overlapping matches that ``keep`` accepts.

    The matches and the strings between them, both from left to right, give the
    positions by adding up lengths, ``CHUNK`` matches at a time: appending to an array
    copies it, and so only short ones are copied for every match.
    """
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))

    def step(done: Column, pair: Column) -> Column:
        start = done["at"] + F.length(pair["gap"])
        span = F.struct(start.alias("start"), (start + F.length(pair["hit"])).alias("stop"), F.lit(kind).alias("kind"),
                        pair["hit"].alias("value"), F.lit(None).cast("double").alias("entropy"))
        wanted = pair["hit"].isNotNull() if keep is None else pair["hit"].isNotNull() & keep(pair["hit"])
        return F.struct(
            (start + F.coalesce(F.length(pair["hit"]), F.lit(0))).alias("at"),
            F.when(wanted, F.concat(done["spans"], F.array(span))).otherwise(done["spans"]).alias("spans"))

    none = F.array().cast(SPAN)

    def chunk(done: Column, k: Column, pairs: Column) -> Column:
        part = F.aggregate(F.slice(pairs, k, F.lit(CHUNK)), F.struct(done["at"].alias("at"), none.alias("spans")), step)
        return _let(part, lambda p: F.struct(p["at"].alias("at"), F.concat(done["spans"], p["spans"]).alias("spans")))

    def all_chunks(pairs: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
        return F.aggregate(F.sequence(F.lit(1), F.size(pairs), F.lit(CHUNK)), start, lambda done, k: chunk(done, k, pairs),
                           lambda done: done["spans"])

    return F.when(text.rlike(pattern), _let(pairs, all_chunks)).otherwise(none)


def _allowed_ends(value: Column, rules: EntropyRules) -> Column:
    """Ends, in order, of the windows that hold an allowed match or lie inside one."""
    w = rules.window

    def ends(m: Column) -> Column:
        # Windows that end from m.stop to m.start + w hold the match, from m.start + w to m.stop they lie in it.
        low = F.greatest(F.least(m["stop"], m["start"] + w), F.lit(w))
        high = F.least(F.greatest(m["stop"], m["start"] + w), F.length(value))
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    def matched(pattern: str) -> Column:
        return F.flatten(F.transform(_found(value, pattern, "allowed"), ends))

    some = F.lit(False)
    for pattern in rules.allowed:
        some = some | value.rlike(pattern)
    found = F.concat(*map(matched, rules.allowed)) if rules.allowed else F.array().cast("array<int>")
    return F.when(some, F.array_sort(F.array_distinct(found))).otherwise(F.array().cast("array<int>"))


def _hot_window(value: Column, allowed: Column, rules: EntropyRules) -> Column:
    """struct<first, last, most, kind>: ends of the first and last window above its class's
    limit (0 if none) whose end isn't in ``allowed``, the greatest entropy of such
    windows and their widest class, from 0."""
    w = rules.window
    weight = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(w + 2)])
    limits = F.array(*map(F.lit, (rules.digit_bits, rules.hex_bits, rules.alnum_bits, rules.base64_bits)))

    def run_of(place: Column) -> Column:
        out = F.lit(len(RUNS))
        for k in reversed(range(len(RUNS))):
            out = F.when(place <= RUNS[k], k + 1).otherwise(out)
        return out

    def class_of(runs: Column) -> Column:
        """The narrowest class of a window, from its counts by run."""
        n = [F.ascii(F.substring(runs, k + 1, 1)) - 65 for k in range(len(RUNS))]
        upper, lower = n[0] + n[1], n[2] + n[3]
        return F.when(n[4] == w, 0).when(n[0] + n[2] + n[4] == w, 1).when(
            (n[5] == 0) & ((upper == 0) | (lower == 0)), 2).otherwise(3)

    def moved(counts: Column, slot: Column, by: Column) -> Column:
        return F.overlay(counts, F.char(F.ascii(F.substring(counts, slot, F.lit(1))) + by), slot, F.lit(1))

    def scan(known: Column) -> Column:
        # Odd events bring character (event + 1) / 2 in, even ones take the one a window back out.
        def event(state: Column, e: Column) -> Column:
            coming = e % 2 == 1
            at = F.when(coming, (e + 1) / 2).otherwise(e / 2 - w + 1).cast("int")
            place = F.when(at > 0, F.instr(F.lit(ALPHABET), F.get(known["chars"], at - 1))).otherwise(0)

            def counted(slot: Column) -> Column:
                by = F.when(coming, 1).otherwise(-1)
                old = F.ascii(F.substring(state["counts"], slot, F.lit(1))) - 65
                total = state["total"] + F.get(weight, old + by) - F.get(weight, old)
                return F.struct(moved(state["counts"], slot, by).alias("counts"), moved(state["runs"], run_of(slot), by).alias("runs"),
                                total.alias("total"))

            def judged(now: Column) -> Column:
                full = coming & (at >= w)
                bits = F.lit(math.log2(w)) - now["total"] / w
                # The next allowed end is never behind: ends are distinct and in order.
                passed = full & (F.coalesce(F.get(known["allowed"], state["skip"]), F.lit(0)) == at)
                kind = F.when(full & ~passed, class_of(now["runs"]))
                hot = F.coalesce(bits > F.get(limits, kind), F.lit(False))
                return F.struct(
                    now["counts"].alias("counts"), now["runs"].alias("runs"), now["total"].alias("total"),
                    F.when(hot & (state["first"] == 0), at).otherwise(state["first"]).alias("first"),
                    F.when(hot, at).otherwise(state["last"]).alias("last"),
                    F.when(hot, F.greatest(state["most"], bits)).otherwise(state["most"]).alias("most"),
                    F.when(hot, F.greatest(state["kind"], kind)).otherwise(state["kind"]).alias("kind"),
                    F.when(passed, state["skip"] + 1).otherwise(state["skip"]).alias("skip"))

            return F.when(at > 0, _let(_let(place, counted), judged)).otherwise(state)

        start = F.struct(F.lit("A" * len(ALPHABET)).alias("counts"), F.lit("A" * len(RUNS)).alias("runs"), F.lit(0.0).alias("total"),
                         F.lit(0).alias("first"), F.lit(0).alias("last"), F.lit(0.0).alias("most"), F.lit(0).alias("kind"),
                         F.lit(0).alias("skip"))
        return F.aggregate(F.sequence(F.lit(1), 2 * F.size(known["chars"])), start, event)

    return _let(F.struct(F.split(value, "", -1).alias("chars"), allowed.alias("allowed")), scan)


def _entropy_spans(text: Column, rules: EntropyRules) -> Column:
    def spans(c: Column) -> Column:
        def judged(ends: Column) -> Column:
            # A candidate whose windows are all allowed needs no scan.
            hot = F.when(F.size(ends) <= F.length(c["value"]) - rules.window, _hot_window(c["value"], ends, rules))
            return _let(hot, lambda s: F.struct(
                (c["start"] + s["first"] - rules.window).alias("start"), (c["start"] + s["last"]).alias("stop"),
                F.get(F.array(*map(F.lit, KINDS[3:])), s["kind"]).alias("kind"),
                F.substring(c["value"], s["first"] - rules.window + 1, s["last"] - s["first"] + rules.window).alias("value"),
                F.when(s["first"] > 0, s["most"]).alias("entropy")))

        return _let(_allowed_ends(c["value"], rules), judged)

    candidates = _found(text, CANDIDATE, "candidate")
    return F.filter(F.transform(candidates, spans), lambda s: s["entropy"].isNotNull()).cast(SPAN)


def _listed(spans: Column) -> Column:
    """In order of start, then kind as listed."""
    keyed = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("rank"),
        s.alias("span")))
    return F.transform(F.array_sort(keyed), lambda k: k["span"])


def scan_secrets(docs: DataFrame, text_col: str = "text", rules: EntropyRules | None = None) -> DataFrame:
    """``docs`` with ``secrets``: array of struct(start, stop, kind, value, entropy).

    One row per row of ``docs``; a column named ``secrets`` is replaced.
    """
    rules = rules or EntropyRules()
    text = F.coalesce(F.col(text_col), F.lit(""))
    spans = F.concat(
        _found(text, ASSIGN, "assign", lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 1)) >= ASSIGNED),
        _found(text, ACCESS, "access"), _found(text, HEX, "hex"), _entropy_spans(text, rules))
    return docs.select(*keep_columns(docs, ["secrets"]), _listed(spans).alias("secrets"))


def contract_rows(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digests per document."""
    spans = F.col("secrets")

    def joined(some: Column) -> Column:
        return F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["kind"].isin(*KINDS[:3]))
    return scanned.select(
        id_col, *map(count, KINDS[:3]),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans"),
        F.size(F.filter(spans, lambda s: ~s["kind"].isin(*KINDS[:3]))).cast("long").alias("n_entropy"))
