"""Operator 3: SentencePiece encoding and decoding on the tokenizers library.

``parse_model`` reads the model file's protobuf (pieces with scores and kinds, trainer and
normaliser settings) and ``build`` makes the same tokenizer for the tokenizers library: the
normaliser (the precompiled map, if any), the space marker with its leading dummy, byte
fallback, and either unigram scores or, for a BPE model, the merges that its scores imply.

A vocabulary in which no piece holds the marker behind another character never merges across
the start of a run of spaces. Texts then fall into units, a run of spaces with the word behind it,
whose ids are remembered, a bounded number of them, and only new units reach the library, a
bounded number at a time on all the threads that TOKENIZERS_PARALLELISM allows: a long text never
goes there in one piece, since the libraries take some hundred bytes for each of its letters. A
literal marker reads as a space, as in both libraries. Parity with the sentencepiece library is
verified on everything that is sent to the library, units and (for other vocabularies) whole
texts alike, and reported per document; where the two differ, the sentencepiece library's ids are taken.

Defined cases: NULL and empty texts have no ids and decode to the empty text; repeated rows
each give a row; a NULL id stays NULL; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardlake.llm.common import give_back, id_and_text

MARKER = "▁"
CACHE_BYTES = 16_000_000  # of what a worker remembers, by the bytes its entries take
ENTRY = 160  # bytes of an entry besides its letters and ids
ROWS = 512
TOGETHER = 16  # words sent to the library in one text
SENT = 1024  # texts sent to the library at a time
# A space and what belongs to it: further spaces and the word behind them.
UNIT = re.compile(" ( *[^ ]*)")
# Fixed values of the model format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    unk_id: int = 0
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra_spaces: bool = True
    escape_spaces: bool = True


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message: varints as int, all else as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        tag = varint()
        wire = tag & 7
        if wire == 0:
            yield tag >> 3, varint()
        else:
            size = varint() if wire == 2 else {1: 8, 5: 4}[wire]
            yield tag >> 3, data[at : at + size]
            at += size


def parse_model(data: bytes) -> Model:
    model = Model()
    for number, value in fields(data):
        if number == 1:  # a piece: text, score, kind
            piece, score, kind = "", 0.0, NORMAL
            for n, v in fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    (score,) = struct.unpack("<f", v)
                elif n == 3:
                    kind = v
            model.pieces.append((piece, score, kind))
        elif number == 2:  # trainer settings
            for n, v in fields(value):
                if n == 3:
                    model.kind = v
                elif n == 35:
                    model.byte_fallback = bool(v)
                elif n == 40:
                    model.unk_id = v
        elif number == 3:  # normaliser settings
            for n, v in fields(value):
                if n == 2:
                    model.charsmap = v
                elif n == 3:
                    model.dummy_prefix = bool(v)
                elif n == 4:
                    model.remove_extra_spaces = bool(v)
                elif n == 5:
                    model.escape_spaces = bool(v)
    return model


def implied_merges(model: Model) -> list[tuple[str, str]]:
    """Pairs of pieces that form a piece: best score of the result first, then by the parts."""
    ids = {piece: i for i, (piece, _, kind) in enumerate(model.pieces) if kind == NORMAL}
    found = []
    for piece in ids:
        score = model.pieces[ids[piece]][1]
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in ids and right in ids:
                found.append((-score, ids[piece], ids[left], ids[right], (left, right)))
    return [pair for *_, pair in sorted(found)]


def build(model: Model):
    """The tokenizers library's form of a model."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    if model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], unk_id=model.unk_id, byte_fallback=model.byte_fallback)
    elif model.kind == BPE:
        core = models.BPE(
            vocab={p: i for i, (p, _, _) in enumerate(model.pieces)}, merges=implied_merges(model),
            unk_token=model.pieces[model.unk_id][0], fuse_unk=True, byte_fallback=model.byte_fallback,
            cache_capacity=0,  # words are remembered here; the library's cache takes 250 MB and half the time
        )
    else:
        raise ValueError(f"model kind {model.kind} is neither unigram nor BPE")
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.remove_extra_spaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARKER if model.escape_spaces else " "))
    if model.escape_spaces:
        steps.append(normalizers.Replace(" ", MARKER))
    tokenizer.normalizer = normalizers.Sequence(steps)
    parts = [decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        parts.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(parts)
    return tokenizer


class Codec:
    """Encodes and decodes by the built tokenizer; compares with the sentencepiece library."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as file:
            data = file.read()
        self.model = parse_model(data)
        self.tokenizer = build(self.model)
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.kind = "<u2" if len(self.model.pieces) <= 1 << 16 else "<u4"
        inside = any(MARKER in p.lstrip(MARKER) for p, _, k in self.model.pieces if k in (NORMAL, USER_DEFINED))
        marker = next((i for i, (p, _, k) in enumerate(self.model.pieces) if p == MARKER and k == NORMAL), None)
        self.by_word = (
            not inside and marker is not None and not self.model.charsmap and self.model.dummy_prefix
            and self.model.escape_spaces and not self.model.remove_extra_spaces
        )
        # A single space at the end of a text is the marker alone.
        self.known: dict[str, bytes] = {"": np.array([marker], dtype=self.kind).tobytes()} if self.by_word else {}
        self.room = CACHE_BYTES
        self.differ: set[str] = set()  # words on which the libraries differ
        self.begins = np.array([p.startswith(MARKER) for p, _, _ in self.model.pieces])
        # What each id stands for, and which are single bytes.
        self.shown = []
        for piece, _, kind in self.model.pieces:
            if kind == BYTE:
                self.shown.append(bytes([int(piece[1:-1], 16)]))
            elif kind in (CONTROL, UNKNOWN):
                self.shown.append(b"" if kind == CONTROL else " ⁇ ".encode())
            else:
                self.shown.append(piece.replace(MARKER, " ").encode())

    def _sent(self, texts: list[str]) -> Iterator[tuple[bytes, bool]]:
        """Ids of texts by the library, and whether the sentencepiece library agrees."""
        for at in range(0, len(texts), SENT):
            some = texts[at : at + SENT]
            own = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            other = self.reference.encode(some, num_threads=1)
            for a, b in zip(own, other):
                yield np.array(b, dtype=self.kind).tobytes(), a.ids == b

    def _units(self, units: list[str]) -> dict[str, bytes]:
        """Ids of units. Those without further spaces go many in one text: each begins at the only
        piece that begins with the marker. Units on which the libraries differ are noted."""
        found: dict[str, bytes] = {}
        alone = [u for u in units if u.startswith(" ")]
        words = [u for u in units if not u.startswith(" ")]
        groups = [words[i : i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        for group, (data, same) in zip(groups, self._sent([" ".join(g) for g in groups])):
            row = np.frombuffer(data, self.kind)
            width = row.dtype.itemsize
            cuts = (np.flatnonzero(self.begins[row]) * width).tolist()
            if not same or len(cuts) != len(group):
                alone += group
                continue
            cuts.append(len(data))
            found.update((w, data[cuts[i] : cuts[i + 1]]) for i, w in enumerate(group))
        for unit, (ids, agree) in zip(alone, self._sent(alone)):
            found[unit] = ids
            if not agree:
                self.differ.add(unit)
        return found

    def _cut(self, text: str) -> list[str]:
        """The units of a text, each without its first space; the first has the dummy's."""
        if not text:
            return []
        text = text.replace(MARKER, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            return UNIT.findall(" " + text)
        return text.split(" ")

    def encode(self, texts: list[str]) -> list[tuple[bytes, bool]]:
        """Little-endian ids of each text, and whether both libraries agree on it."""
        if not self.by_word:
            odd = list(set(texts))
            whole = dict(zip(odd, self._sent(odd)))
            return [whole[t] for t in texts]
        known = self.known
        cut = [self._cut(t) for t in texts]
        new = self._units(list({u for row in cut for u in row if u not in known}))
        size = sum(len(w) + len(ids) for w, ids in new.items()) + ENTRY * len(new)
        if size <= self.room:
            self.room -= size
            known.update(new)
            new = {}
        out = []
        for row in cut:
            ids = [known[u] if u in known else new[u] for u in row] if new else map(known.__getitem__, row)
            out.append((b"".join(ids), self.differ.isdisjoint(row) if self.differ else True))
        return out

    def decode(self, ids: bytes) -> str:
        """The text of little-endian ids: pieces joined, bytes read as UTF-8, marker dropped."""
        text = b"".join(map(self.shown.__getitem__, np.frombuffer(ids, self.kind).tolist()))
        decoded = text.decode("utf-8", "replace")
        return decoded[1:] if self.model.dummy_prefix and decoded.startswith(" ") else decoded


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec per worker process."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
        give_back()  # what its making took
    return _CODECS[path]


def encoder(path: str):
    """(doc_id, text) to the ids; texts go to the worker and do not come back."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work = codec(path)
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                some = batch.slice(at, ROWS)
                texts = some.column("text").to_pylist()
                found = at_work.encode(texts)
                width = np.dtype(at_work.kind).itemsize
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("doc_id"),
                        pa.array([len(ids) // width for ids, _ in found], pa.int64()),
                        pa.array([ids for ids, _ in found], pa.binary()),
                        pa.array([at_work.decode(ids) == t for (ids, _), t in zip(found, texts)], pa.bool_()),
                        pa.array([same for _, same in found], pa.bool_()),
                    ],
                    names=["doc_id", "n_ids", "ids", "round_trip", "parity"],
                )
        give_back()

    return encode


def sentencepiece_codec(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_ids, ids (little-endian, 2 bytes each up to 65,536 pieces, else 4), whether they
    decode to the text, and whether the sentencepiece library gives the same ids."""
    rows = id_and_text(docs, id_col, text_col)
    return rows.mapInArrow(encoder(model_path), "doc_id long, n_ids long, ids binary, round_trip boolean, parity boolean")


def decode_ids(rows: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and the text of little-endian ids; NULL ids give a NULL text."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work = codec(model_path)
        for batch in batches:
            texts = [None if ids is None else at_work.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    picked = rows.select(rows[id_col].cast("long").alias("doc_id"), F.col(ids_col).cast("binary").alias("ids"))
    return picked.mapInArrow(decode, "doc_id long, text string")
