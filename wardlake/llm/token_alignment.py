"""Operator 13: the tokens of two tokenizers aligned by the bytes they cover.

A is a byte-level vocabulary applied to a space and the text, B a SentencePiece model, which adds
that space itself. Both cover the same bytes, so a pointer into A's tokens and one into B's walk
along a document together: every step links the two tokens under the pointers, then moves the
pointer whose token ends first, or both where they end at the same byte, which is a cut between
two groups. The walk is done for all documents of a pack in lockstep: the pointers are two NumPy
vectors, one step moves all of them, and documents that are through are taken out of the vectors.
Documents of more than ``SEGMENT`` tokens enter as several rows that begin at common cuts, so
one long document does not walk alone.

What links say about the corpus comes from two aggregations. A task folds the links of a pack of
documents into distinct id pairs with their number of documents; only those pairs travel: to their
counts over the corpus, to the greatest count of each A id, and back to their pack. A pack
is at most ``PACK_BYTES`` of text, or one document, and no pair of a pack has more than a row.

Defined cases: a text that is NULL, empty, or whose tokens of A or B do not give back a space and
the text has no tokens: all figures 0, the hash an empty string. Repeated rows are documents of
their own, each counted. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from wardlake.llm.common import id_and_text, written

PACK_BYTES = 4_000_000
PACK_DOCS = 4_096
DOC_BITS = 12
SEGMENT = 1_024
MARKER = "▁"
_LOADED: dict[tuple[str, str], Pair] = {}


def byte_letters() -> dict[str, int]:
    """The characters a byte-level vocabulary writes bytes as: printable Latin-1 ones stand for
    themselves, the others, in order, for what follows U+0100."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


class Pair:
    """Both tokenizers of a worker, with the bytes and the decimal text of each id."""

    def __init__(self, json_path: str, model_path: str):
        import sentencepiece
        import tiktoken
        from public_tokenizers import PATTERN

        letters = byte_letters()
        with open(json_path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items()}
        # Merges are the vocabulary in the order of its ids, so the ids are ranks; no special tokens.
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.b_bytes = [self._piece(i) for i in range(self.b.vocab_size())]
        self.a_sizes = np.array([len(t) for t in self.a_bytes], dtype=np.int64)
        self.b_sizes = np.array([len(t) for t in self.b_bytes], dtype=np.int64)
        # An id in a group's text: A followed by ',' or '|', B followed by ',' or ';'.
        self.texts = [f"{i}{end}" for end in ",|" for i in range(len(self.a_bytes))]
        self.texts += [f"{i}{end}" for end in ",;" for i in range(len(self.b_bytes))]

    def _piece(self, i: int) -> bytes:
        if self.b.is_control(i) or self.b.is_unknown(i):
            return b""
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace(MARKER, " ").encode()

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and of B for each text; none where a side does not give back its bytes.

        Tokens of A are pieces of the text in order, so they are all of it if their sizes add up.
        """
        found = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1)):
            spaced = " " + text
            a = self.a.encode_to_numpy(spaced, allowed_special=set(), disallowed_special=()).astype(np.int64)
            data = spaced.encode()
            same = text and b"".join(map(self.b_bytes.__getitem__, b)) == data and self.a_sizes[a].sum() == len(data)
            found.append((a, np.array(b, dtype=np.int64)) if same else (a[:0], a[:0]))
        return found


def tokenizers(json_path: str, model_path: str) -> Pair:
    if (json_path, model_path) not in _LOADED:
        _LOADED[json_path, model_path] = Pair(json_path, model_path)
    return _LOADED[json_path, model_path]


def walk(a_ends: np.ndarray, b_ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links (i, j), and cuts (last i, last j), of all rows ``(a begin, a end, b begin)`` in lockstep."""
    i, stop, j = rows[:, 0].copy(), rows[:, 1], rows[:, 2].copy()
    links_i, links_j, cuts_i, cuts_j = [], [], [], []
    while len(i):
        links_i.append(i)
        links_j.append(j)
        a_end, b_end = a_ends[i], b_ends[j]
        both = a_end == b_end
        cuts_i.append(i[both])
        cuts_j.append(j[both])
        i = i + (a_end <= b_end)
        j = j + (b_end <= a_end)
        going = i < stop
        if not going.all():
            i, j, stop = i[going], j[going], stop[going]
    empty = np.empty(0, dtype=rows.dtype)
    return tuple(np.concatenate([empty, *parts]) for parts in (links_i, links_j, cuts_i, cuts_j))


def segments(a_begin: int, b_begin: int, a_ends: np.ndarray, b_ends: np.ndarray, segment: int) -> list[tuple[int, int, int]]:
    """A document's rows for ``walk``: one, or more that begin at cuts ``segment`` tokens apart."""
    n = len(a_ends)
    if n <= segment:
        return [(a_begin, a_begin + n, b_begin)]
    at = np.searchsorted(b_ends, a_ends)
    common = np.flatnonzero(b_ends[at] == a_ends)  # the last token's end is one of them
    picked = common[np.unique(np.searchsorted(common, np.arange(segment - 1, n, segment)).clip(max=len(common) - 1))]
    stops = np.unique(np.append(picked, n - 1))
    starts = np.concatenate(([-1], stops[:-1]))
    return [
        (a_begin + s + 1, a_begin + e + 1, b_begin + (int(at[s]) + 1 if s >= 0 else 0))
        for s, e in zip(starts.tolist(), stops.tolist())
    ]


def group_hashes(pair: Pair, a: np.ndarray, b: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray, sizes: list[tuple[int, int]]) -> list[str]:
    """The hash of each document's groups; cuts are the last tokens of all groups, in order."""
    group_a, group_b = np.diff(a_cuts, prepend=-1), np.diff(b_cuts, prepend=-1)
    n_a, n_b = len(pair.a_bytes), len(pair.b_bytes)
    a_text, b_text = a.copy(), b + 2 * n_a
    a_text[a_cuts] += n_a
    b_text[b_cuts] += n_b
    sequence = np.empty(len(a) + len(b), dtype=np.int64)
    # A token stands behind all tokens of A before it and all of B in earlier groups.
    sequence[np.arange(len(a)) + np.repeat(b_cuts + 1 - group_b, group_a)] = a_text
    sequence[np.arange(len(b)) + np.repeat(a_cuts + 1, group_b)] = b_text
    found, at = [], 0
    for x, y in sizes:
        text = "".join(map(pair.texts.__getitem__, sequence[at : at + x + y].tolist()))
        at += x + y
        found.append(hashlib.sha256(text[:-1].encode()).hexdigest() if text else "")
    return found


def planes(values: np.ndarray, width: int) -> bytes:
    """Non-negative integers as compressed byte planes."""
    import zstandard

    raw = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(raw.T).tobytes())


def from_planes(data: bytes, width: int) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(raw.T).view(f"<u{width}").ravel().astype(np.int64)


PACKS = pa.schema([
    ("pack", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("figures", pa.list_(pa.int64())), ("hashes", pa.list_(pa.string())),
    ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("docs", pa.list_(pa.int64())), ("link_docs", pa.binary()), ("link_counts", pa.binary()),
])
PACK_DDL = (
    "pack long, doc_ids array<long>, figures array<long>, hashes array<string>, a array<int>, b array<int>, "
    "docs array<long>, link_docs binary, link_counts binary"
)


def align(pair: Pair, pack: int, ids: list[int | None], texts: list[str], segment: int = SEGMENT) -> dict:
    """A pack's row: figures per document, distinct id pairs, and which documents hold them how often."""
    tokens = pair.encode(texts)
    sizes = [(len(x), len(y)) for x, y in tokens]
    a, b = (np.concatenate(side) for side in zip(*tokens))
    a_ends, b_ends = np.cumsum(pair.a_sizes[a]), np.cumsum(pair.b_sizes[b])
    rows, at_a, at_b = [], 0, 0
    for n_a, n_b in sizes:
        if n_a:
            rows += segments(at_a, at_b, a_ends[at_a : at_a + n_a], b_ends[at_b : at_b + n_b], segment)
        at_a, at_b = at_a + n_a, at_b + n_b
    i, j, a_cuts, b_cuts = walk(a_ends, b_ends, np.array(rows, dtype=np.int64).reshape(-1, 3))
    a_cuts.sort()
    b_cuts.sort()
    doc_of = np.repeat(np.arange(len(ids)), [n for n, _ in sizes])
    docs = doc_of[i]
    n_links, n_groups = np.bincount(docs, minlength=len(ids)), np.bincount(doc_of[a_cuts], minlength=len(ids))
    # One sort brings equal pairs together and, in a pair, the links of one document.
    keys = (a[i] * len(pair.b_bytes) + b[j]) << DOC_BITS | docs
    keys.sort()
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    held, times = keys[first], np.diff(first, append=len(keys))
    pairs = held >> DOC_BITS
    begins = np.flatnonzero(np.diff(pairs, prepend=-1))
    distinct = pairs[begins]
    figures = np.array([n for row in zip(sizes, n_groups.tolist(), n_links.tolist()) for n in (*row[0], row[1], row[2])], dtype=np.int64)
    return {
        "pack": pack,
        "doc_ids": ids,
        "figures": figures,
        "hashes": group_hashes(pair, a, b, a_cuts, b_cuts, sizes),
        "a": (distinct // len(pair.b_bytes)).astype(np.int32),
        "b": (distinct % len(pair.b_bytes)).astype(np.int32),
        "docs": np.diff(begins, append=len(pairs)),
        "link_docs": planes(held & ((1 << DOC_BITS) - 1), 2),
        "link_counts": planes(times, 8),
    }


def aligner(json_path: str, model_path: str, pack_bytes: int, segment: int):
    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizers(json_path, model_path)
        pack = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0

        def row() -> pa.RecordBatch:
            found = align(pair, pack, ids, texts, segment)
            return pa.RecordBatch.from_arrays([pa.array([found[f.name]], f.type) for f in PACKS], schema=PACKS)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                texts.append(text.as_py())
                size += len(texts[-1])
                if size >= pack_bytes or len(ids) >= PACK_DOCS:
                    yield row()
                    ids, texts, size, pack = [], [], 0, pack + 1
        if ids:
            yield row()

    return packs


OUT = pa.schema([
    *((n, pa.int64()) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), ("groups_sha256", pa.string()),
])
OUT_DDL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packs with the counts of their pairs to a row per document."""
    for batch in batches:
        for k in range(len(batch)):
            one = batch.slice(k, 1)
            ids = one.column("doc_ids").flatten()
            figures = one.column("figures").flatten().to_numpy().reshape(-1, 4)
            known = one.column("known").flatten()
            order = np.argsort(known.field("at").to_numpy())
            counts = known.field("count").to_numpy()[order]
            best = known.field("best").to_numpy(zero_copy_only=False)[order]
            width = one.column("docs").flatten().to_numpy()
            n_best, count_sum = np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids), dtype=np.int64)
            if len(width):
                doc = from_planes(one.column("link_docs")[0].as_py(), 2)
                times = from_planes(one.column("link_counts")[0].as_py(), 8)
                np.add.at(n_best, doc, times * np.repeat(best, width))
                np.add.at(count_sum, doc, times * np.repeat(counts, width))
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(figures[:, c]) for c in range(4)), pa.array(n_best), pa.array(count_sum), one.column("hashes").flatten()],
                schema=OUT,
            )


def pair_counts(asked: DataFrame) -> DataFrame:
    """(a, b, count, best): documents per id pair, and whether no pair of that ``a`` has more."""
    counts = written(asked.groupBy("a", "b").agg(F.sum("docs").alias("count")), "pairs")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def token_alignment(
    docs: DataFrame,
    json_path: str,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    pack_bytes: int = PACK_BYTES,
    segment: int = SEGMENT,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
    rows = id_and_text(docs, id_col, text_col)
    packs = written(rows.mapInArrow(aligner(json_path, model_path, pack_bytes, segment), PACK_DDL), "packs")
    asked = packs.select("pack", F.posexplode(F.arrays_zip("a", "b", "docs")).alias("at", "one")).select("pack", "at", "one.*")
    known = (
        asked.drop("docs")
        .join(pair_counts(asked.drop("pack", "at")), ["a", "b"])
        .groupBy("pack")
        .agg(F.collect_list(F.struct("at", "count", "best")).alias("known"))
    )
    held = packs.select("pack", "doc_ids", "figures", "hashes", "docs", "link_docs", "link_counts").join(known, "pack", "left")
    nothing = F.array().cast("array<struct<at:int,count:bigint,best:boolean>>")
    return held.withColumn("known", F.coalesce("known", nothing)).mapInArrow(finish, OUT_DDL)
