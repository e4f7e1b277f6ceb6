"""Operator 2: token ids in files, each a wavelet matrix.

Documents are encoded with a tokenizers vocabulary, an end id is appended to each, and the ids
are written in ascending ``doc_id`` order: a range partitioning by id, a sort inside each
partition, and in it one file per ``SHARD_TOKENS`` ids. A file holds a wavelet matrix: a
bit plane for each binary digit of the ids, highest first, each stably sorted by the digits
above it. With the running counts of ones per block, a file answers from its planes alone
what stands at a position (``access``), how often an id occurs before a position (``rank``),
where its k-th occurrence is (``select``), and gives back all ids (``tokens``).

Layout of a file: 6 bytes magic, uint32 little-endian length of a JSON header, the header,
then zstandard frames: document ids (int64), tokens per document (int64), NULL-id flags (bytes), and for each plane
its bits (packed, low bit first). Block counts are rebuilt from the planes when a file is
opened. A file is written under a temporary name and then moved, so a task that runs again
leaves one whole file.

Defined cases: NULL texts count as empty and give just the end id; NULL ids come first;
repeated ids are ordered by their text; an empty table gives no file and no row.
"""

from __future__ import annotations

import json
import string
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from wardlake.llm.common import id_and_text
from wardlake.sources.shared import shared_folder

MAGIC = b"WLWM1\n"
SHARD_TOKENS = 1 << 22
BLOCK = 512  # bits per entry of the rank directory
CACHE_WORDS = 400_000
CACHE_PIECES = 700_000
ENCODE_ROWS = 2_048
# Words of printable ASCII and Latin-1 letters, and where the usual pre-tokenizer cuts them once they are lower-cased.
PLAIN = "^[!-~À-ÖØ-öø-ÿ]+$"
PIECES = "'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+"
LATIN = "".join(map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
# Byte-level vocabularies write bytes that are no visible Latin-1 character as those from U+0100 on.
_HIDDEN = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
BYTE_LEVEL = {b: 0x100 + i for i, b in enumerate(_HIDDEN)}
_ENCODERS: dict[tuple[str, int], Encoder] = {}


class WaveletMatrix:
    """The planes of one sequence of non-negative integers."""

    def __init__(self, length: int, planes: list[np.ndarray], zeros: list[int]):
        self.length, self.planes, self.zeros = length, planes, zeros
        self._blocks: dict[int, np.ndarray] = {}

    @classmethod
    def build(cls, symbols: np.ndarray, bits: int) -> WaveletMatrix:
        planes, zeros, rest = [], [], symbols
        for shift in range(bits - 1, -1, -1):
            ones = (rest & rest.dtype.type(1 << shift)).astype(bool)
            planes.append(np.packbits(ones, bitorder="little"))
            low = rest.take(np.flatnonzero(~ones))
            zeros.append(len(low))
            rest = np.concatenate((low, rest.take(np.flatnonzero(ones))))
        return cls(len(symbols), planes, zeros)

    def _plane_ones(self, plane: int) -> np.ndarray:
        """Ones before each block of BLOCK bits."""
        if plane not in self._blocks:
            packed = self.planes[plane]
            per_byte = np.bitwise_count(packed).astype(np.int64)
            per_block = np.add.reduceat(per_byte, np.arange(0, len(packed), BLOCK // 8)) if len(packed) else per_byte
            self._blocks[plane] = np.concatenate(([0], np.cumsum(per_block)))
        return self._blocks[plane]

    def _ones_before(self, plane: int, at: int) -> int:
        block, rest = divmod(at, BLOCK)
        total = int(self._plane_ones(plane)[block])
        part = self.planes[plane][block * (BLOCK // 8) : block * (BLOCK // 8) + (rest + 7) // 8]
        return total + int(np.unpackbits(part, bitorder="little")[:rest].sum())

    def _bit(self, plane: int, at: int) -> int:
        return int(self.planes[plane][at >> 3]) >> (at & 7) & 1

    def access(self, at: int) -> int:
        """The symbol at a position."""
        if not 0 <= at < self.length:
            raise IndexError(at)
        symbol = 0
        for plane, zeros in enumerate(self.zeros):
            bit, ones = self._bit(plane, at), self._ones_before(plane, at)
            symbol = symbol << 1 | bit
            at = zeros + ones if bit else at - ones
        return symbol

    def _range(self, symbol: int, at: int) -> tuple[int, int]:
        """In the last ordering: where the symbol's run begins, and ends for positions < at."""
        low, high, bits = 0, at, len(self.planes)
        if symbol >> bits:
            return 0, 0
        for plane, zeros in enumerate(self.zeros):
            ones_low, ones_high = self._ones_before(plane, low), self._ones_before(plane, high)
            if symbol >> (bits - 1 - plane) & 1:
                low, high = zeros + ones_low, zeros + ones_high
            else:
                low, high = low - ones_low, high - ones_high
        return low, high

    def rank(self, symbol: int, at: int) -> int:
        """Occurrences of a symbol before a position."""
        low, high = self._range(symbol, at)
        return high - low

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.length)

    def _nth(self, plane: int, k: int, one: bool) -> int:
        """Position of the k-th (from 0) one or zero of a plane."""
        before = self._plane_ones(plane)
        if not one:
            before = np.arange(len(before)) * BLOCK - before
        block = int(np.searchsorted(before, k, side="right")) - 1
        part = self.planes[plane][block * (BLOCK // 8) : (block + 1) * (BLOCK // 8)]
        bits = np.unpackbits(part, bitorder="little").astype(bool)
        return block * BLOCK + int(np.flatnonzero(bits == one)[k - int(before[block])])

    def select(self, symbol: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of a symbol."""
        low, high = self._range(symbol, self.length)
        if not 0 <= k < high - low:
            raise IndexError(k)
        at, bits = low + k, len(self.planes)
        for plane in range(bits - 1, -1, -1):
            one = bool(symbol >> (bits - 1 - plane) & 1)
            at = self._nth(plane, at - self.zeros[plane] if one else at, one)
        return at

    def occurrences(self, symbol: int) -> list[int]:
        """All positions of a symbol."""
        return [self.select(symbol, k) for k in range(self.count(symbol))]

    def tokens(self) -> np.ndarray:
        """The whole sequence as uint32."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        rest = np.zeros(self.length, dtype=kind)
        for shift, (plane, zeros) in enumerate(zip(self.planes[::-1], self.zeros[::-1])):
            ones = np.unpackbits(plane, count=self.length, bitorder="little").astype(bool)
            rest[zeros:] |= kind(1 << shift)
            out = np.empty_like(rest)
            out[~ones] = rest[:zeros]
            out[ones] = rest[zeros:]
            rest = out
        return rest.astype(np.uint32)


def to_bytes(ids: list[int | None], counts: np.ndarray, tokens: np.ndarray, bits: int) -> bytes:
    """A file's contents."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=1).compress
    matrix = WaveletMatrix.build(tokens, bits)
    parts = [
        pack(np.array([i or 0 for i in ids], dtype="<i8").tobytes()),
        pack(counts.astype("<i8").tobytes()),
        pack(bytes(i is None for i in ids)),
        *(pack(plane.tobytes()) for plane in matrix.planes),
    ]
    header = json.dumps(
        {"tokens": matrix.length, "documents": len(ids), "zeros": matrix.zeros, "parts": [len(p) for p in parts]}
    ).encode()
    return b"".join((MAGIC, struct.pack("<I", len(header)), header, *parts))


def from_bytes(data: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """Document ids, tokens per document and the matrix of a file."""
    import zstandard

    if not data.startswith(MAGIC):
        raise ValueError("not a token file")
    (size,) = struct.unpack_from("<I", data, len(MAGIC))
    at = len(MAGIC) + 4 + size
    header = json.loads(data[len(MAGIC) + 4 : at])
    parts = []
    for length in header["parts"]:
        parts.append(zstandard.ZstdDecompressor().decompress(data[at : at + length]))
        at += length
    ids = [None if null else i for i, null in zip(np.frombuffer(parts[0], "<i8").tolist(), parts[2])]
    planes = [np.frombuffer(p, np.uint8) for p in parts[3:]]
    matrix = WaveletMatrix(header["tokens"], planes, header["zeros"])
    return ids, np.frombuffer(parts[1], "<i8"), matrix


class IdTable:
    """Rows of ids, one after the other in one array."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        self.ids, self.counts = ids, counts
        self.starts = np.cumsum(counts) - counts

    @classmethod
    def of(cls, rows: list[bytes], kind: str) -> IdTable:
        counts = np.fromiter(map(len, rows), np.int64, len(rows)) // np.dtype(kind).itemsize
        return cls(np.frombuffer(b"".join(rows), kind), counts)

    def joined(self, rows: np.ndarray, offsets: np.ndarray) -> IdTable:
        """The ids of the given rows, those between two offsets as one row."""
        counts = self.counts[rows]
        ends = np.cumsum(counts)
        ids = self.ids[np.repeat(self.starts[rows] - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)]
        return IdTable(ids, np.diff(np.concatenate(([0], ends))[offsets]))


def distinct_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of texts, the place of each word among them, and where the words of each text begin and end.

    Arrow's ASCII white space is that of bytes.split(); beside it, it gives empty words.
    """
    split = pc.ascii_split_whitespace(texts)
    words = split.flatten().dictionary_encode()
    return words.dictionary, words.indices.to_numpy(), split.offsets.to_numpy()


class Encoder:
    """Texts to ids by a tokenizers vocabulary, each distinct word of a batch once.

    Going by words is only right for vocabularies that drop white space and cut at it, so
    that a text's ids are those of its words; that is tried on the vocabulary itself, and
    others encode whole texts. Up to ``CACHE_WORDS`` words are remembered, the first ones seen.

    Words that differ in case or punctuation alone share most of their pieces. Where the vocabulary
    lower-cases and cuts words of ``PLAIN`` as ``PIECES`` does, which is tried on pairs of their
    characters, such words are not remembered: their ids are put together from those of their pieces, and only new
    pieces go to the library's model, without its normaliser and pre-tokenizer; up to ``CACHE_PIECES`` are kept.
    """

    SEPARATOR = "photography"  # stands between words that are encoded in one go
    TOGETHER = 100

    def __init__(self, path: str, bits: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u2" if bits <= 16 else "<u4"
        self.known: dict[bytes, bytes] = {}
        probe = "Ab, c'd 12\t<|endoftext|>x\nété \x1cq z\u00a0z"
        self.by_word = self._ids(probe) == [i for w in probe.encode().split() for i in self._ids(w.decode())]
        mark = self._ids(self.SEPARATOR)
        self.mark = mark[0] if len(mark) == 1 else None
        self.pieces: dict[bytes, bytes] = {}
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.by_piece = self.by_word and self._cuts_as_pieces()

    def _cuts_as_pieces(self) -> bool:
        """Whether words of any two characters of ``PLAIN``, and contractions, are their pieces."""
        letters = string.digits + string.ascii_letters + string.punctuation
        words = [a + b for a in letters for b in letters] + [a + b for a in LATIN for b in LATIN]
        words += [w for a in LATIN for b in "aZ0'.,-~" for w in (a + b, b + a, f"x{b}{a}", f"{a}{b}x")]
        words += [a + w + b for w in ("'re", "'VE", "'ll", "'S", "'t", "''d", "'m'") for a in ("", "x", "7", "'", ".", "é") for b in ("", "X", "7", "'", ".", "É")]
        words = [w.encode() for w in words]
        words = [w for w in words if not any(a in w for a in self.added)]
        whole = self._joint(words)
        cut = self._cut(pa.array([w.decode() for w in words], pa.string()))
        return all(whole[w] == cut.ids[a : a + n].tobytes() for w, a, n in zip(words, cut.starts.tolist(), cut.counts.tolist()))

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.kind).tobytes()

    def _batch(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The ids of words."""
        table = self._of_words(pa.array([w.decode() for w in words], pa.string()))
        return {w: table.ids[a : a + n].tobytes() for w, a, n in zip(words, table.starts.tolist(), table.counts.tolist())}

    def _of_words(self, words: pa.Array) -> IdTable:
        """The ids of words, by their pieces where that is right."""
        if not self.by_piece:
            return self._whole(words)
        plain = pc.match_substring_regex(words, PLAIN)
        for added in self.added:
            plain = pc.and_not(plain, pc.match_substring(words, added.decode()))
        cut, whole = self._cut(words.filter(plain)), self._whole(words.filter(pc.invert(plain)))
        plain = plain.to_numpy(zero_copy_only=False)
        place = np.empty(len(words), dtype=np.int64)
        place[plain], place[~plain] = np.arange(len(cut.counts)), len(cut.counts) + np.arange(len(whole.counts))
        both = IdTable(np.concatenate((cut.ids, whole.ids)), np.concatenate((cut.counts, whole.counts)))
        return both.joined(place, np.arange(len(words) + 1))

    def _whole(self, words: pa.Array) -> IdTable:
        """The ids of words as the library gives them, or as they are remembered."""
        words = words.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        return IdTable.of(self._kept(self.known, words, lambda new: self._joint(list(new)), CACHE_WORDS), self.kind)

    def _cut(self, words: pa.Array) -> IdTable:
        """The ids of plain words by their pieces."""
        apart = pc.replace_substring_regex(pc.utf8_lower(words), f"({PIECES})", r"\1 ")
        pieces, places, offsets = distinct_words(apart)
        pieces = pieces.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        return IdTable.of(self._kept(self.pieces, pieces, self._merged, CACHE_PIECES), self.kind).joined(places, offsets)

    @staticmethod
    def _kept(known: dict[bytes, bytes], keys: list[bytes], find: Callable, room: int) -> list[bytes]:
        """The ids of keys; new ones are looked for, and remembered while there is room."""
        rows = list(map(known.get, keys))
        new = find({k for k, row in zip(keys, rows) if row is None and k})
        if len(known) + len(new) <= room:
            known.update(new)
        return [b"" if not k else new[k] if row is None else row for k, row in zip(keys, rows)]

    def _merged(self, pieces: set[bytes]) -> dict[bytes, bytes]:
        """The ids that the library's model gives for pieces as they are."""
        merge, ids, ends = self.tokenizer.model.tokenize, [], []
        for piece in pieces:
            visible = piece.decode() if piece.isascii() else piece.decode("latin-1").translate(BYTE_LEVEL)
            ids += [t.id for t in merge(visible)]
            ends.append(len(ids))
        data, width = self._pack(ids), np.dtype(self.kind).itemsize
        return {p: data[width * a : width * b] for p, a, b in zip(pieces, [0, *ends], ends)}

    def _joint(self, new: list[bytes]) -> dict[bytes, bytes]:
        """The ids of words, a hundred of them in one text with a separator in between."""
        found: dict[bytes, bytes] = {}
        apart = []
        groups = [new[i : i + self.TOGETHER] for i in range(0, len(new), self.TOGETHER)]
        if self.mark is None:
            groups, apart = [], new
        joint = f" {self.SEPARATOR} "
        for group, ids in zip(groups, self._batch([joint.join(w.decode() for w in g) for g in groups])):
            row = np.array(ids, dtype=self.kind)
            cuts = np.flatnonzero(row == self.mark)
            if len(cuts) != len(group) - 1:  # a word holds the separator
                apart.extend(group)
                continue
            data, width = row.tobytes(), row.dtype.itemsize
            begin = 0
            for word, cut in zip(group, [*cuts.tolist(), len(row)]):
                found[word] = data[begin * width : cut * width]
                begin = cut + 1
        found.update((w, self._pack(ids)) for w, ids in zip(apart, self._batch([w.decode() for w in apart])))
        return found

    def table(self, texts: pa.Array) -> IdTable:
        """The ids of each text."""
        if not self.by_word:
            return IdTable.of([self._pack(ids) for ids in self._batch(texts.to_pylist())], self.kind)
        words, places, offsets = distinct_words(texts)
        return self._of_words(words).joined(places, offsets)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text."""
        table = self.table(pa.array(texts, pa.string()))
        return [table.ids[a : a + n].tobytes() for a, n in zip(table.starts.tolist(), table.counts.tolist())]


def encoder(path: str, bits: int) -> Encoder:
    """One encoder per worker process."""
    if (path, bits) not in _ENCODERS:
        _ENCODERS[path, bits] = Encoder(path, bits)
    return _ENCODERS[path, bits]


def writer(folder: str, vocabulary: str, end_id: int, bits: int, shard_tokens: int):
    """Documents in order to files below ``folder``; yields a row for each file."""

    def flush(files, root: str, part: int, k: int, ids: list, chunks: list[np.ndarray]) -> dict:
        counts = np.array([len(c) for c in chunks], dtype=np.int64)
        tokens = np.concatenate(chunks)
        name = f"part-{part:06d}-{k:06d}.wm"
        partial = f"{root}/.{name}.{uuid.uuid4().hex}"
        with files.open_output_stream(partial) as out:
            out.write(to_bytes(ids, counts, tokens, bits))
        files.move(partial, f"{root}/{name}")
        return {"file": name, "part": part, "k": k, "n_docs": len(ids), "n_tokens": len(tokens)}

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        encode = encoder(vocabulary, bits).table
        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        part = TaskContext.get().partitionId()
        done, ids, chunks, size = [], [], [], 0
        for batch in batches:
            for at in range(0, len(batch), ENCODE_ROWS):
                some = batch.slice(at, ENCODE_ROWS)
                table = encode(some.column(1))
                ends = np.cumsum(table.counts)
                tokens = np.insert(table.ids, ends, end_id)
                begins = ends - table.counts + np.arange(len(ends))  # with the end ids before
                for doc_id, begin, n in zip(some.column(0).to_pylist(), begins.tolist(), (table.counts + 1).tolist()):
                    ids.append(doc_id)
                    chunks.append(tokens[begin : begin + n])
                    size += n
                    if size >= shard_tokens:
                        done.append(flush(files, root, part, len(done), ids, chunks))
                        ids, chunks, size = [], [], 0
        if ids:
            done.append(flush(files, root, part, len(done), ids, chunks))
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=MANIFEST)

    return write


MANIFEST = pa.schema([("file", pa.string()), ("part", pa.int32()), ("k", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])
SHARD_ROWS = pa.schema(
    [("file", pa.string()), ("doc_id", pa.int64()), ("offset", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
)


def read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files to a row per document: where it begins in its file, its length and checksum."""
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids, counts, matrix = from_bytes(content.as_py())
            data = memoryview(matrix.tokens().astype("<u4").tobytes())
            ends = np.cumsum(counts)
            begins = ends - counts
            sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([path.rsplit("/", 1)[-1]] * len(ids), pa.string()), pa.array(ids, pa.int64()),
                    pa.array(begins, pa.int64()), pa.array(counts, pa.int64()), pa.array(sums, pa.int64()),
                ],
                schema=SHARD_ROWS,
            )


def write_token_files(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    end_id: int = 2,
    bits: int = 16,
    shard_tokens: int = SHARD_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write the files below ``folder``; returns the manifest, a row per file, also kept there."""
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col)
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    manifest = ordered.mapInArrow(
        writer(f"{folder}/shards", vocabulary, end_id, bits, shard_tokens),
        "file string, part int, k int, n_docs long, n_tokens long",
    )
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.schema(manifest.schema).parquet(f"{folder}/manifest")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    spark = manifest.sparkSession
    # Start of a file: the partitions before its own (a row each), then the files before it.
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        manifest.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(parts, "part")
        .select("file", (F.col("part_start") + F.col("inside")).alias("file_start"))
    )
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.wm").load(f"{folder}/shards").select("path", "content")
        if manifest.head(1)
        else spark.createDataFrame([], "path string, content binary")
    )
    rows = files.mapInArrow(read_back, "file string, doc_id long, offset long, n_tokens long, ids_crc32 long")
    return rows.join(starts, "file").select(
        "doc_id", (F.col("file_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(docs: DataFrame, vocabulary: str, end_id: int = 2, folder: str | None = None, **options) -> DataFrame:
    """Write the ids of ``docs`` below ``folder`` (default: a new shared one) and read them back."""
    folder = folder or f"{shared_folder(docs.sparkSession)}/token_files"
    return read_token_files(write_token_files(docs, folder, vocabulary, end_id, **options), folder)
