"""Operator 12: BPE encoding and decoding by batched NumPy merge rounds.

A batch's texts are cut into words as the vocabulary's own normaliser and pre-tokenizer cut
them. The words a worker does not know yet are laid out as one flat array of symbol ids. A round
looks up all adjacent pairs of a word by binary search over the sorted pair keys, finds
the lowest rank of each word, and merges every place of that pair, left to right without overlap;
words without a known pair leave the array. Where a merge could make a pair of lower rank
than its own (the vocabulary is asked for that when it is loaded), only the first place is merged
in a round, which is the order of the library.

Words of printable ASCII and the letters of Latin-1 are cut by one expression, equal there to the
vocabulary's pattern (tried when it is loaded); others by the library. Vocabularies that do not drop white space
and cut at it (tried on the vocabulary itself) have whole texts cut by the library.

Decoding looks up each id's token: without a decoder in the vocabulary tokens are joined by a
space, with the byte-level one their bytes are joined and read as UTF-8, bad bytes replaced.

Defined cases: a NULL text counts as empty and has no ids; strings of special tokens inside a text
are those tokens, as the library has it; repeated rows give repeated rows; an empty table gives
an empty table. Other kinds of vocabulary raise. A word of any length is encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wardlake.llm.common import id_and_text
from wardlake.llm.token_alignment import byte_letters

ROWS = 1_024
CACHE_WORDS = 300_000
SPECIAL = "\0 "  # before a special token among words, of which none holds a space
NO_RANK = np.iinfo(np.int64).max
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+"
_LOADED: dict[str, Codec] = {}


class Merges:
    """A vocabulary's merges as sorted pair keys with the rank and the product of each."""

    def __init__(self, vocabulary: dict[str, int], merges: list):
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([vocabulary[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.int64)
        self.base = max(vocabulary.values()) + 1
        keys = left * self.base + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.products = keys[order], order.astype(np.int64), made[order]
        self.product_of = made
        # Rank by rank: may a merge's product be part of a pair of lower rank?
        rank = np.arange(len(pairs))
        earliest = np.full(self.base, NO_RANK)
        np.minimum.at(earliest, left, rank)
        np.minimum.at(earliest, right, rank)
        self.one_by_one = earliest[made] <= rank

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``NO_RANK`` for pairs that are none."""
        if not len(self.keys):
            return np.full(len(left), NO_RANK)
        wanted = left * self.base + right
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == wanted, self.ranks[at], NO_RANK)

    def encode(self, symbols: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """The ids of words, as little-endian unsigned 32-bit integers; the words are given as one
        flat array of symbols and their sizes."""
        found = [b""] * len(sizes)
        word = np.arange(len(sizes))  # the words still in the array
        rank = np.append(self.lookup(symbols[:-1], symbols[1:]), NO_RANK)[: len(symbols)]
        rank[np.cumsum(sizes) - 1] = NO_RANK  # no pair reaches over a word's end
        while len(word):
            starts = np.cumsum(sizes) - sizes
            lowest = np.minimum.reduceat(rank, starts)
            done = lowest == NO_RANK
            if done.any():
                stay = np.repeat(~done, sizes)
                data, end = symbols[~stay].astype("<u4").tobytes(), 0
                for w, size in zip(word[done].tolist(), (4 * sizes[done]).tolist()):
                    found[w] = data[end : end + size]
                    end += size
                symbols, rank = symbols[stay], rank[stay]
                word, sizes, lowest = word[~done], sizes[~done], lowest[~done]
                if not len(word):
                    break
            owner = np.repeat(np.arange(len(word)), sizes)
            places = np.flatnonzero(rank == lowest[owner])
            places = places[self._kept(places, owner[places], lowest)]
            symbols[places] = self.product_of[rank[places]]
            rank[places] = rank[places + 1]  # NO_RANK if the word ends here
            rest = np.ones(len(symbols), dtype=bool)
            rest[places + 1] = False
            sizes = sizes - np.bincount(owner[places], minlength=len(word))
            symbols, rank = symbols[rest], rank[rest]
            # Only pairs with a new symbol are looked up again.
            new = places - np.arange(len(places))
            ends = np.zeros(len(symbols), dtype=bool)
            ends[np.cumsum(sizes) - 1] = True
            again = np.concatenate((new, new[new > 0] - 1))
            again = again[~ends[again]]
            rank[again] = self.lookup(symbols[again], symbols[again + 1])
            rank[ends] = NO_RANK
        return found

    def _kept(self, places: np.ndarray, owner: np.ndarray, lowest: np.ndarray) -> np.ndarray:
        """Which places are merged: every other one of a run that overlaps, or a word's first."""
        run_begins = np.diff(places, prepend=-2) != 1
        position = np.arange(len(places))
        in_run = position - np.maximum.accumulate(np.where(run_begins, position, 0))
        first = np.diff(owner, prepend=-1) != 0
        return np.where(self.one_by_one[lowest[owner]], first, in_run % 2 == 0)


class Codec:
    """A tokenizers vocabulary of kind BPE over byte letters."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        unlike = model.get("continuing_subword_prefix"), model.get("byte_fallback"), model.get("ignore_merges"), model.get("dropout")
        if model["type"] != "BPE" or any(unlike) or '"ByteLevel"' not in json.dumps(spec["pre_tokenizer"]):
            raise ValueError(f"{path}: only byte-level BPE vocabularies are supported")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.merges = Merges(model["vocab"], model["merges"])
        self.suffix = model.get("end_of_word_suffix") or ""
        self.vocabulary = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_ids = {SPECIAL + t: i.to_bytes(4, "little") for t, i in self.special.items()}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens with rules of their own are not supported")
        self.special_mark = os.path.commonprefix(list(self.special)) if self.special else SPECIAL  # all begin with it
        self.special_text = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        letters = byte_letters()
        letter_of = {b: c for c, b in letters.items()}
        # Symbol of a byte inside a word and at its end, and of a letter likewise.
        self.inside = np.array([self.vocabulary.get(letter_of[b], -1) for b in range(256)], dtype=np.int64)
        self.ending = np.array([self.vocabulary.get(letter_of[b] + self.suffix, -1) for b in range(256)], dtype=np.int64)
        self.byte_of = letters
        self.joiner, self.token_bytes = self._decoder(spec["decoder"])
        self.by_word = self._cuts_at_spaces()
        self.cut = re.compile(PATTERN).findall if self._plain_pattern() else None
        self.known: dict[bytes, bytes] = {}

    def _decoder(self, spec: dict | None) -> tuple[bytes, list[bytes]]:
        tokens = {i: t for t, i in self.vocabulary.items()} | {i: t for t, i in self.special.items()}
        table = [tokens.get(i, "") for i in range(max(tokens) + 1)]
        if spec is None:
            return b" ", [t.encode() for t in table]
        if spec["type"] != "ByteLevel":
            raise ValueError("only vocabularies without a decoder or with the byte-level one are supported")
        # A token with any other character stands for its own text.
        return b"", [bytes(self.byte_of[c] for c in t) if all(c in self.byte_of for c in t) else t.encode() for t in table]

    def _cuts_at_spaces(self) -> bool:
        probe = "Ab, c'd 12\tx\nété \x1cq z z  end's 'll"
        spaced = any(t.split() != [t] for t in self.special)
        return not spaced and self._pieces(probe) == [p for w in probe.encode().split() for p in self._pieces(w.decode())]

    def _plain_pattern(self) -> bool:
        """Does ``PATTERN`` cut plain words as the vocabulary does? Tried on sequences of all kinds of characters."""
        kinds = ["a", "Z", "'s", "'LL", "'", "7", "!", "-", "'t", "re", "_", "É", "ß", "ÿ"]
        probe = [a + b + c + d for a in kinds for b in kinds for c in kinds for d in ("", "x", "'")]
        probe += [chr(c) + "a" + chr(c) for c in range(0x21, 0x100) if PLAIN.fullmatch(chr(c))]
        return self.by_word and all([w.encode() for w in re.findall(PATTERN, p.lower())] == self._pieces(p) for p in probe)

    def _pieces(self, text: str) -> list[bytes]:
        """Words of a text without special tokens, as bytes, by the library."""
        plain = self.library.normalizer.normalize_str(text) if self.library.normalizer else text
        return [bytes(map(self.byte_of.__getitem__, p)) for p, _ in self.library.pre_tokenizer.pre_tokenize_str(plain)]

    def _parts(self, unit: str) -> list[str | bytes]:
        """The words of a unit (or text) as bytes, or text if plain, and the special tokens in it, in order."""
        if self.cut and PLAIN.fullmatch(unit) and self.special_mark not in unit:
            return self.cut(unit.lower())
        parts: list[str | bytes] = []
        for k, part in enumerate(self.special_text.split(unit) if self.special else [unit]):
            if k % 2:
                parts.append(SPECIAL + part)
            elif part:
                parts.extend(self._pieces(part))
        return parts

    def _words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word."""
        flat = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        symbols = self.inside[flat]
        last = np.cumsum(sizes) - 1
        symbols[last] = self.ending[flat[last]]
        if (symbols < 0).any():
            raise ValueError("the vocabulary lacks a byte")
        return self.merges.encode(symbols, sizes)

    def _units(self, units: list[bytes]) -> dict[bytes, bytes]:
        parts = [self._parts(u.decode()) for u in units]
        words = list({w for row in parts for w in row if w not in self.special_ids})
        found = self._words([w if isinstance(w, bytes) else w.encode() for w in words])
        ids = dict(zip(words, found)) | self.special_ids
        return {u: b"".join(map(ids.__getitem__, row)) for u, row in zip(units, parts)}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        rows = [t.encode().split() if self.by_word else [t.encode()] for t in texts]
        known = self.known
        new = self._units(list({u for row in rows for u in row if u not in known}))
        if self.by_word and len(known) + len(new) <= CACHE_WORDS:
            known.update(new)
            return [b"".join(map(known.__getitem__, row)) for row in rows]
        return [b"".join([known[u] if u in known else new[u] for u in row]) for row in rows]

    def decode(self, data: bytes) -> str:
        """The text of little-endian ids, special tokens included."""
        ids = np.frombuffer(data, "<u4").tolist()
        return self.joiner.join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


def codec(path: str) -> Codec:
    """One codec per worker process."""
    if path not in _LOADED:
        _LOADED[path] = Codec(path)
    return _LOADED[path]


def _some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            yield batch.slice(at, ROWS)


def bpe_encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``ids``, little-endian unsigned 32-bit integers, of every row."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = codec(vocabulary)
        for some in _some(batches):
            ids = pa.array(table.encode(some.column(1).to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([some.column(0), ids], names=["doc_id", "ids"])

    return id_and_text(docs, id_col, text_col).mapInArrow(encode, "doc_id long, ids binary")


def bpe_decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id`` and ``text`` of every row of ``bpe_encode``."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = codec(vocabulary)
        for some in _some(batches):
            found = pa.array([table.decode(data) for data in some.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([some.column(0), found], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")


def bpe_codec(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and the hashes of the ids and of the decoded text of every row, in one pass."""

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = codec(vocabulary)
        for some in _some(batches):
            found = table.encode(some.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    some.column(0),
                    pa.array([len(d) // 4 for d in found], pa.int64()),
                    pa.array([hashlib.sha256(d).hexdigest() for d in found]),
                    pa.array([hashlib.sha256(table.decode(d).encode()).hexdigest() for d in found]),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(
        both, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
