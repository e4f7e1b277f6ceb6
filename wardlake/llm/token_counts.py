"""Operator 7: tokens per document, huge documents by overlapping chunks.

A document longer than ``chunk_bytes`` is encoded in chunks that overlap by ``overlap``
bytes, each with its tokens' offsets. Two neighbours are spliced at a boundary that
both have and that is stable: the start of a run of spaces. It is proven stable by the
vocabulary, in which no piece holds the space marker behind another character, so that no
merge crosses it, whatever stands on either side. Where an overlap has none, it is doubled,
up to the rest of the document. The sum over the chunks is the count of the whole text, and
no more than a chunk and its offsets are in the library at a time.

Defined cases: NULL and empty texts have no tokens; repeated rows each give a row; a NULL id
stays NULL; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from wardlake.llm.common import id_and_text

MARKER = "▁"
CHUNK_BYTES = 32_768
OVERLAP = 512
_LOADED: dict[str, tuple[object, bool]] = {}


def processor(path: str) -> tuple[object, bool]:
    """The loaded model, and whether the start of a run of spaces is a stable boundary in it."""
    if path not in _LOADED:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()))
        inside = any(MARKER in piece.lstrip(MARKER) for piece in pieces)
        # Only an identity normaliser keeps runs of spaces, and so the offsets, as they are.
        plain = sp.encode("a  b", out_type=str) != sp.encode("a b", out_type=str)
        _LOADED[path] = (sp, plain and not inside)
    return _LOADED[path]


def starts(sp, data: bytes) -> list[int]:
    """Where each token of the UTF-8 text ``data`` begins, in bytes."""
    return [piece.begin for piece in sp.encode(data.decode(), return_type="proto").pieces]


def whole_character(data: bytes, at: int) -> int:
    """``at``, or the start of the character it lies in."""
    while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def stable_cut(data: bytes, left: set[int], right: set[int], low: int, high: int) -> int | None:
    """The last position in (low, high) where both tokenisations begin a run of spaces."""
    at = data.rfind(b" ", low + 1, high)
    while at > low:
        before = data[max(0, at - 3) : at]
        if not before.endswith((b" ", MARKER.encode())) and at in left and at in right:
            return at
        at = data.rfind(b" ", low + 1, at)
    return None


def chunked_count(sp, text: str, chunk: int = CHUNK_BYTES, overlap: int = OVERLAP) -> int:
    """The number of tokens of ``text``, from chunks spliced at stable boundaries."""
    data = text.encode()
    begin, total, done = 0, 0, 0  # tokens that start before `done` are counted
    end = whole_character(data, min(len(data), chunk))
    found = starts(sp, data[:end])
    while end < len(data):
        least = max(begin, done)
        low, width, cut = end, min(overlap, end - least), None
        while cut is None and low > least:
            low = whole_character(data, max(least, end - width))
            far = whole_character(data, min(len(data), end + chunk))
            after = [low + s for s in starts(sp, data[low:far])]
            cut = stable_cut(data, {begin + s for s in found}, set(after), max(low, done), end)
            width *= 2
        if cut is None:
            # No common boundary back to the last cut: this chunk and the next become one.
            end = whole_character(data, min(len(data), end + max(chunk, end - begin)))
            found = starts(sp, data[begin:end])
            continue
        total += sum(done <= begin + s < cut for s in found)
        begin, end, done, found = low, far, cut, [s - low for s in after]
    return total + sum(begin + s >= done for s in found)


def counter(path: str, chunk: int, overlap: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp, stable = processor(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sizes = [len(t.encode()) for t in texts]
            counts = [0] * len(texts)
            small = [i for i, n in enumerate(sizes) if n <= chunk or not stable]
            for at in range(0, len(small), 64):
                some = small[at : at + 64]
                for i, ids in zip(some, sp.encode([texts[i] for i in some], num_threads=1)):
                    counts[i] = len(ids)
            for i in set(range(len(texts))).difference(small):
                counts[i] = chunked_count(sp, texts[i], chunk, overlap)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(counts, pa.int64()),
                ],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    return count


def token_counts(
    docs: DataFrame,
    model_path: str,
    limit: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    overlap: int = OVERLAP,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document, one row for each row."""
    rows = id_and_text(docs, id_col, text_col).mapInArrow(
        counter(model_path, chunk_bytes, overlap), "doc_id long, n_bytes long, n_tokens long"
    )
    return rows.withColumn("over_limit", rows["n_tokens"] > limit)
