"""Operator 1: substring dedup with suffix automata of reference shards.

A window is ``WINDOW`` consecutive words of a document; a word is removed if a window that
covers it also starts anywhere else, in this document or another. Windows are judged on the
input. Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.

The reference of such a corpus is the corpus, so its automata have no size bound and are not
broadcast. Instead documents and reference meet by anchors, and only passages that can repeat
are kept as reference:

1. Every window has an anchor: the least of its ``GRAM``-word hashes, the rightmost of equals. Equal
   windows have the same anchor at the same place. Consecutive windows with one anchor form a
   segment, at most ``2 * WINDOW - GRAM`` words. Anchors are counted with partial sums; those
   that occur once, nearly all, end here.
2. Where all segments of an anchor are equal, all their windows repeat, and so do those of
   any segment that occurs twice.
3. Where an anchor has different segments, they are reference and query at once. Anchors are
   dealt to shards; each shard builds the suffix automaton of its distinct segments, with the
   occurrences of each state, streams the segments through it for matching statistics, and
   keeps the windows whose match of full length occurs twice or more. An anchor with more
   than ``HOT_SEGMENTS`` different segments would make a shard too large: its windows
   are counted one by one instead, by a hash of 128 bits and with partial sums.
4. Documents with repeated windows remove the maximal spans that these cover.

A row is known by its id and a hash of its text. Hashes have 64 bits for anchors (which only
bring segments together) and 128 for segments together with their anchor.

Defined cases: NULL texts count as empty; a text below a window loses nothing; the kept words of
an empty document are the empty text; repeated rows are copies of each other and lose what
copies lose; NULL ids are allowed; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardlake.llm.common import gram_hashes, id_and_text, mix, same_row, word_hashes, words, written

WINDOW = 35
GRAM = 8
HOT_SEGMENTS = 64
SHARD_WORDS = 60_000
ROWS = 512


def anchored(hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per segment its anchor's position, and its first and last window."""
    grams = gram_hashes(hashes, gram)
    width = window - gram + 1
    n = len(grams) - width + 1
    if n <= 0:
        none = np.empty(0, dtype=np.int64)
        return none, none, none
    # argmin takes the first of equals; reversed windows make that the rightmost.
    turned = np.lib.stride_tricks.sliding_window_view(grams[::-1], width)[::-1]
    places = np.arange(n) + (width - 1) - turned.argmin(axis=1)
    first = np.flatnonzero(np.concatenate(([True], places[1:] != places[:-1])))
    last = np.concatenate((first[1:], [n])) - 1
    return places[first], first, last


_BASE = 0xD1342543DE82EF95
_POWERS = np.ones(1, dtype=np.uint64)
_INVERSES = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base, and of its inverse modulo 2^64."""
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = 1 << n.bit_length()
        made = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            row = np.full(size, base, dtype=np.uint64)
            row[0] = 1
            made.append(np.cumprod(row, dtype=np.uint64))
        _POWERS, _INVERSES = made
    return _POWERS[:n], _INVERSES[:n]


def run_hashes(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each run hashes[begin:end] of words, also of its length."""
    power, inverse = _powers(len(hashes) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)) * power[:-1], dtype=np.uint64)))
    return mix((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64))


def segments(window: int, gram: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                some = batch.slice(at, ROWS)
                counts, parts = [], []
                for text in some.column(2).to_pylist():
                    found = words(text)
                    if len(found) < window:
                        counts.append(0)
                        continue
                    hashes = word_hashes(found)
                    place, first, last = anchored(hashes, window, gram)
                    # The place inside the segment is part of what makes segments equal.
                    segment = run_hashes(hashes, first, last + window) ^ mix((place - first).astype(np.uint64) + np.uint64(1))
                    parts.append((gram_hashes(hashes, gram)[place].view(np.int64), first, (last - first), segment.view(np.int64)))
                    counts.append(len(first))
                repeat = np.repeat(np.arange(len(some)), counts)
                columns = [np.concatenate(c) if c else np.empty(0, np.int64) for c in (zip(*parts) if parts else [()] * 4)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(pa.array(repeat)), some.column(1).take(pa.array(repeat))] + [pa.array(c, pa.int64()) for c in columns],
                    names=["doc_id", "text_key", "anchor", "first", "more", "segment"],
                )

    return find


class SuffixAutomaton:
    """Of several word sequences, each with a number of occurrences."""

    def __init__(self):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _state(self, length: int, link: int, arcs: dict[bytes, int]) -> int:
        self.next.append(arcs)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.next) - 1

    def _split(self, state: int, symbol: bytes, target: int) -> int:
        clone = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = clone
        while state >= 0 and self.next[state].get(symbol) == target:
            self.next[state][symbol] = clone
            state = self.link[state]
        return clone

    def add(self, sequence: list[bytes], weight: int) -> None:
        """Add a sequence that occurs ``weight`` times."""
        last = 0
        for symbol in sequence:
            target = self.next[last].get(symbol)
            if target is not None:
                last = target if self.length[target] == self.length[last] + 1 else self._split(last, symbol, target)
            else:
                new, state = self._state(self.length[last] + 1, 0, {}), last
                while state >= 0 and symbol not in self.next[state]:
                    self.next[state][symbol] = new
                    state = self.link[state]
                if state >= 0:
                    target = self.next[state][symbol]
                    self.link[new] = target if self.length[target] == self.length[state] + 1 else self._split(state, symbol, target)
                last = new
            self.count[last] += weight

    def finish(self) -> None:
        """Hand occurrences down the suffix links; call once, after the last sequence."""
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.count[self.link[state]] += self.count[state]

    def matches(self, sequence: list[bytes], least: int) -> Iterator[tuple[int, int]]:
        """Matching statistics: (begin, occurrences) of every run of ``least`` words that matches."""
        state = matched = 0
        for end, symbol in enumerate(sequence, 1):
            while state and symbol not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if symbol in self.next[state]:
                state, matched = self.next[state][symbol], matched + 1
            else:
                state = matched = 0
            while state and self.length[self.link[state]] >= least:
                state = self.link[state]
                matched = self.length[state]
            if matched >= least:
                yield end - least, self.count[state]


def repeated_windows(window: int):
    """A shard's distinct segments (anchor, segment, n, words) to the offsets of repeated windows."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in b.to_pylist()]
        automaton, sequences = SuffixAutomaton(), [r["words"].encode("utf-8", "surrogatepass").split() for r in rows]
        for row, sequence in zip(rows, sequences):
            automaton.add(sequence, row["n"])
        automaton.finish()
        out = []
        for row, sequence in zip(rows, sequences):
            offsets = [begin for begin, n in automaton.matches(sequence, window) if n > 1] if row["n"] == 1 else []
            if offsets:
                out.append({"anchor": row["anchor"], "segment": row["segment"], "offsets": offsets})
        yield pa.RecordBatch.from_pylist(out, schema=OFFSETS)

    return solve


OFFSETS = pa.schema([("anchor", pa.int64()), ("segment", pa.int64()), ("offsets", pa.list_(pa.int64()))])
OFFSETS_DDL = "anchor long, segment long, offsets array<long>"


def window_hashes(window: int):
    """Hot segments (anchor, segment, n, words) to a row per window with its hash."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                found = words(row["words"])
                for at in range(len(found) - window + 1):
                    key = hashlib.blake2b(b" ".join(found[at : at + window]), digest_size=16).digest()
                    out.append({"anchor": row["anchor"], "segment": row["segment"], "n": row["n"], "offset": at, "key": key})
            yield pa.RecordBatch.from_pylist(
                out, schema=pa.schema([("anchor", pa.int64()), ("segment", pa.int64()), ("n", pa.int64()), ("offset", pa.int64()), ("key", pa.binary())])
            )

    return split


def cut(found: list[bytes], begins: np.ndarray, ends: np.ndarray) -> tuple[int, str]:
    """How many words the half-open spans cover, and the hash of the words that are left."""
    change = np.zeros(len(found) + 1, dtype=np.int64)
    np.add.at(change, begins, 1)
    np.add.at(change, ends, -1)
    kept = np.cumsum(change[:-1]) == 0
    left = [found[i] for i in np.flatnonzero(kept).tolist()] if len(begins) else found
    return len(found) - len(left), hashlib.sha256(b" ".join(left)).hexdigest()


def first_pass(window: int):
    """Rows with their repeated segments: to a result, or to what the shards have to settle."""

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                out = []
                for row in batch.slice(at, ROWS).to_pylist():
                    found, sure, open_, shown = words(row["text"]), [], [], []
                    for s in row["repeats"] or []:
                        if s["settled"]:
                            sure.append((s["first"], s["first"] + s["more"] + window))
                        else:
                            open_.append({"anchor": s["anchor"], "segment": s["segment"], "first": s["first"]})
                        if s["shown"]:
                            text = b" ".join(found[s["first"] : s["first"] + s["more"] + window]).decode("utf-8", "surrogatepass")
                            shown.append({"anchor": s["anchor"], "segment": s["segment"], "n": s["n"], "hot": s["hot"], "words": text})
                    result = {"n_removed": None, "kept_sha256": None, "text": None, "sure": None, "open": None}
                    if open_:
                        result |= {"text": row["text"], "open": open_, "sure": [{"begin": a, "end": b} for a, b in sure]}
                    else:
                        spans = np.array(sure, dtype=np.int64).reshape(-1, 2)
                        result["n_removed"], result["kept_sha256"] = cut(found, spans[:, 0], spans[:, 1])
                    out.append({"doc_id": row["doc_id"], "text_key": row["text_key"], "n_words": len(found), **result, "shown": shown})
                yield pa.RecordBatch.from_pylist(out, schema=DECIDED)

    return decide


DECIDED = pa.schema([
    ("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
    ("text", pa.string()), ("sure", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
    ("open", pa.list_(pa.struct([("anchor", pa.int64()), ("segment", pa.int64()), ("first", pa.int64())]))),
    ("shown", pa.list_(pa.struct([("anchor", pa.int64()), ("segment", pa.int64()), ("n", pa.int64()), ("hot", pa.bool_()), ("words", pa.string())]))),
])
DECIDED_DDL = (
    "doc_id long, text_key long, n_words long, n_removed long, kept_sha256 string, text string, "
    "sure array<struct<begin:long,end:long>>, open array<struct<anchor:long,segment:long,first:long>>, "
    "shown array<struct<anchor:long,segment:long,n:long,hot:boolean,words:string>>"
)


def second_pass(window: int):
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                spans = [(s["begin"], s["end"]) for s in row["sure"]]
                spans += [(s, s + window) for part in row["found"] or [] for s in part]
                both = np.array(spans, dtype=np.int64).reshape(-1, 2)
                removed, sha = cut(words(row["text"]), both[:, 0], both[:, 1])
                out.append({"doc_id": row["doc_id"], "n_words": row["n_words"], "n_removed": removed, "kept_sha256": sha})
            yield pa.RecordBatch.from_pylist(
                out, schema=pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
            )

    return finish


def substring_dedup(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT_SEGMENTS, shard_words: int = SHARD_WORDS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row."""
    rows = id_and_text(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    found = rows.mapInArrow(segments(window, gram), "doc_id long, text_key long, anchor long, first long, more long, segment long")
    # 1. Anchors that occur more than once, and whether their segments differ.
    repeated = (
        found.groupBy("anchor").agg(F.count("*").alias("n"), F.min("segment").alias("low"), F.max("segment").alias("high"))
        .where("n > 1").select("anchor", (F.col("low") == F.col("high")).alias("settled"))
    )
    # Written first, so that the join reads plain partitions, which Spark splits where an anchor is hot.
    repeats = written(found.join(written(repeated, "anchors"), "anchor"), "repeats")
    # 2. Distinct segments of the others: occurrences, and one row that is to show its words.
    unsettled = repeats.where(~F.col("settled"))
    distinct = unsettled.groupBy("anchor", "segment").agg(
        F.count("*").alias("n"), F.min(F.struct("doc_id", "text_key", "first")).alias("shows")
    )
    sizes = distinct.groupBy("anchor").agg((F.count("*") > hot).alias("hot"))
    distinct = written(distinct.join(sizes, "anchor"), "distinct")
    known = unsettled.drop("settled").join(distinct, ["anchor", "segment"]).select(
        "doc_id", "text_key", "anchor", "segment", "first", "more", "n", "hot", (F.col("n") > 1).alias("settled"),
        F.struct("doc_id", "text_key", "first").eqNullSafe(F.col("shows")).alias("shown"),
    )
    sure = repeats.where("settled").select(
        "doc_id", "text_key", "anchor", "segment", "first", "more", F.lit(2).cast("long").alias("n"), F.lit(False).alias("hot"),
        "settled", F.lit(False).alias("shown"),
    )
    # A set, so that repeated rows do not add up; at most the segments of one text.
    parts = F.struct("anchor", "segment", "first", "more", "n", "hot", "settled", "shown")
    per_row = sure.unionByName(known).groupBy("doc_id", "text_key").agg(F.collect_set(parts).alias("repeats"))
    decided = written(
        same_row(rows, per_row).select("doc_id", "text_key", "text", "repeats").mapInArrow(first_pass(window), DECIDED_DDL), "decided"
    )
    # 3. The shards.
    shown = written(decided.select(F.explode("shown").alias("s")).select("s.*").dropDuplicates(["anchor", "segment"]), "shown")
    cold = shown.where(~F.col("hot"))
    total = cold.agg(F.sum(F.length("words") - F.length(F.replace("words", F.lit(" "))) + 1)).head()[0] or 0
    shards = max(1, -(-total // shard_words))
    dealt = cold.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    settled = dealt.groupBy("shard").applyInArrow(_by_table(repeated_windows(window)), OFFSETS_DDL)
    each = shown.where("hot").mapInArrow(window_hashes(window), "anchor long, segment long, n long, offset long, key binary")
    often = each.groupBy("key").agg(F.sum("n").alias("total")).where("total > 1").select("key")
    hot_found = each.join(often, "key").groupBy("anchor", "segment").agg(F.collect_list("offset").alias("offsets"))
    offsets = settled.unionByName(hot_found)
    # 4. Rows that waited for the shards.
    waiting = decided.where("open is not null").select("doc_id", "text_key", F.explode("open").alias("o")).select("doc_id", "text_key", "o.*")
    begins = F.transform("offsets", lambda o: o + F.col("first"))
    spans = waiting.join(offsets, ["anchor", "segment"]).groupBy("doc_id", "text_key").agg(F.collect_set(begins).alias("found"))
    late = same_row(decided.where("open is not null"), spans).select("doc_id", "n_words", "text", "sure", "found")
    late = late.mapInArrow(second_pass(window), "doc_id long, n_words long, n_removed long, kept_sha256 string")
    return decided.where("open is null").select("doc_id", "n_words", "n_removed", "kept_sha256").unionByName(late)


def _by_table(solve):
    def run(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(solve(iter(table.to_batches()))), schema=OFFSETS)

    return run
