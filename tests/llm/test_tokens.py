"""Token files, the SentencePiece codec and token counts against the libraries."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.data import documents, frame, texts, tuples
from wardlake.llm import sentencepiece_codec, token_counts, token_files

ROWS = documents(seed=2, groups=8)
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "bcd", " ", "  ", "é", "😀", "\n", "hello", "▁", "the thing", "x" * 30, "\t", "unbelievable", "<s>", "<0x41>", "aaaa", "日本"]


def odd_texts(n, seed=1, longest=150):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) + rng.choice([" ", "", "", " "]) for _ in range(rng.randrange(longest))) for _ in range(n)]


@pytest.mark.parametrize("length", [0, 1, 7, 511, 512, 513, 4000])
def test_wavelet_matrix(length):
    symbols = np.random.default_rng(length).integers(0, 300, length).astype(np.uint16)
    matrix = token_files.WaveletMatrix.build(symbols, 16)
    plain = symbols.tolist()
    assert matrix.tokens().tolist() == plain
    for at in range(0, length, max(1, length // 9)):
        symbol = matrix.access(at)
        assert symbol == plain[at]
        assert matrix.rank(symbol, at) == plain[:at].count(symbol)
        assert matrix.occurrences(symbol) == [i for i, s in enumerate(plain) if s == symbol]
    assert matrix.count(301) == matrix.count(1 << 20) == 0
    with pytest.raises(IndexError):
        matrix.access(length)
    with pytest.raises(IndexError):
        matrix.select(5, plain.count(5))


def test_file_round_trip():
    tokens = np.array([5, 2, 7, 7, 2, 2], dtype=np.uint16)
    ids, counts, matrix = token_files.from_bytes(token_files.to_bytes([4, None, 6], np.array([2, 3, 1]), tokens, 16))
    assert (ids, counts.tolist(), matrix.tokens().tolist()) == ([4, None, 6], [2, 3, 1], tokens.tolist())
    with pytest.raises(ValueError):
        token_files.from_bytes(b"something else")


def test_words_apart_give_the_ids_of_the_text():
    library = Tokenizer.from_file(WORD_BPE)
    encoder = token_files.Encoder(WORD_BPE, 16)
    assert encoder.by_word
    odd = [*odd_texts(100), "photography photography,x", "Σας ΟΔΟΣ\x85a\x1cb", "<|endoftext|> x<|startoftext|>y", ""]
    for text, data in zip(odd, encoder.encode(odd)):
        assert np.frombuffer(data, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids


def test_plain_words_go_by_their_pieces(monkeypatch):
    """Words that differ in case or punctuation alone reach the library once; ids are its own, also beyond the cache."""
    library = Tokenizer.from_file(WORD_BPE)
    rng = random.Random(5)
    marks = ["", "'s", "'LL", ",", "...", "''", "'", "7", "42%", "-x", "<|", "<|endoftext|>", "é", "\x1f", "_"]
    odd = [" ".join(rng.choice(marks) + rng.choice(["Don", "photography", "UNBELIEVABLE", "qzx", ""]) + rng.choice(marks) for _ in range(60)) for _ in range(60)]
    for room in (token_files.CACHE_PIECES, 3):
        monkeypatch.setattr(token_files, "CACHE_PIECES", room)
        encoder = token_files.Encoder(WORD_BPE, 16)
        assert encoder.by_piece
        for at in (0, 30):
            for text, data in zip(odd[at : at + 30], encoder.encode(odd[at : at + 30])):
                assert np.frombuffer(data, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(encoder.pieces) <= room
    sent = []
    monkeypatch.setattr(encoder, "_joint", lambda new: sent.extend(new) or {})
    encoder._words([b"Sesquipedal,", b"SESQUIPEDAL", b"sesquipedal..."])
    assert not sent


def test_latin_words_go_by_their_pieces(monkeypatch):
    """Accented words too reach the library's model once, whatever their case and marks, and never its normaliser."""
    library = Tokenizer.from_file(WORD_BPE)
    rng = random.Random(6)
    letters = [*map(chr, range(0xC0, 0x100)), "a", "Z", "7", "'s", "'", "-"]
    odd = [" ".join("".join(rng.choice(letters) for _ in range(rng.randrange(7))) for _ in range(40)) for _ in range(80)]
    odd += ["  ", "\x0b a\x0c ", "", "x" * 300, "e\u0301te\u0301 \u01c5 \u0130x ﬁ", "Ünï\u00a0cödé"]
    encoder = token_files.Encoder(WORD_BPE, 16)
    for text, data in zip(odd, encoder.encode(odd)):
        assert np.frombuffer(data, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids
    sent, merged, plain = [], [], encoder._merged
    monkeypatch.setattr(encoder, "_joint", lambda new: sent.extend(new) or {})
    monkeypatch.setattr(encoder, "_merged", lambda new: merged.extend(new) or plain(new))
    encoder.encode(["Überlänge, ÜBERLÄNGE überlänge...", "überlänge (Überlänge)"])
    assert not sent and sorted(merged) == sorted(x.encode() for x in [",", "...", "(", ")", "überlänge"] if x.encode() in merged)
    assert merged.count("überlänge".encode()) == 1


def test_ids_of_rows_are_joined():
    table = token_files.IdTable.of([b"", b"\x01\0\x02\0", b"\x03\0"], "<u2")
    found = table.joined(np.array([2, 1, 0, 1]), np.array([0, 0, 3, 4, 4]))
    assert (found.ids.tolist(), found.counts.tolist(), found.starts.tolist()) == ([3, 1, 2, 1, 2], [0, 3, 2, 0], [0, 0, 3, 5])
    none = table.joined(np.array([], dtype=np.int64), np.array([0]))
    assert (len(none.ids), len(none.counts)) == (0, 0)


@pytest.mark.parametrize("shard_tokens", [1 << 22, 50])
def test_token_files(spark, shard_tokens):
    library = Tokenizer.from_file(WORD_BPE)
    expected, start = [], 0
    for doc_id, text in sorted(texts(ROWS), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = token_files.token_files(frame(spark, ROWS), WORD_BPE, end_id=2, shard_tokens=shard_tokens)
    assert tuples(found, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(expected, key=repr)


def test_token_files_of_nothing(spark):
    assert token_files.token_files(frame(spark, []), WORD_BPE).count() == 0


def test_codec_equals_the_library():
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    codec = sentencepiece_codec.Codec(PIECE_BPE)
    odd = [*odd_texts(150, seed=4), "", " ", " a", "a ", "plain words only"]
    for text, (data, same) in zip(odd, codec.encode(odd)):
        ids = np.frombuffer(data, codec.kind).tolist()
        assert same and ids == library.encode(text)
        assert codec.decode(data) == library.decode(ids) == codec.tokenizer.decode(ids, skip_special_tokens=False)
        assert codec.decode(data) == text.replace("▁", " ")


def test_unigram_model_is_rebuilt():
    pieces = [("<unk>", 0.0, 2), ("▁", -3.0, 1), ("a", -2.0, 1), ("b", -2.5, 1), ("▁ab", -1.0, 1), ("<0x63>", 0.0, 6)]
    model = sentencepiece_codec.Model(pieces, sentencepiece_codec.UNIGRAM, 0, True, b"", True, False, True)
    tokenizer = sentencepiece_codec.build(model)
    assert tokenizer.encode("ab a", add_special_tokens=False).ids == [4, 1, 2]
    assert tokenizer.encode("c", add_special_tokens=False).ids == [1, 5]


def test_codec_rows(spark):
    rows = sentencepiece_codec.sentencepiece_codec(frame(spark, ROWS), PIECE_BPE).cache()
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    expected = sorted(((i, len(library.encode(t or "")), True, True) for i, t in texts(ROWS)), key=repr)
    assert tuples(rows, "doc_id", "n_ids", "round_trip", "parity") == expected
    decoded = sentencepiece_codec.decode_ids(rows, PIECE_BPE)
    assert tuples(decoded, "doc_id", "text") == sorted(((i, t or "") for i, t in texts(ROWS)), key=repr)
    assert sentencepiece_codec.sentencepiece_codec(frame(spark, []), PIECE_BPE).count() == 0


@pytest.mark.parametrize("chunk, overlap", [(50, 8), (31, 3), (400, 40)])
def test_chunks_are_spliced_right(chunk, overlap):
    sp, stable = token_counts.processor(PIECE_BPE)
    assert stable
    for text in [*odd_texts(60, seed=9, longest=300), "x" * 700 + " " + "y" * 500, "é" * 400, " " * 300]:
        assert token_counts.chunked_count(sp, text, chunk, overlap) == len(sp.encode(text))


def test_token_counts(spark):
    sp, _ = token_counts.processor(PIECE_BPE)
    found = token_counts.token_counts(frame(spark, ROWS), PIECE_BPE, limit=100, chunk_bytes=200, overlap=20)
    expected = []
    for i, text in texts(ROWS):
        n = len(sp.encode(text or ""))
        expected.append((i, len((text or "").encode()), n, n > 100))
    assert tuples(found, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(expected, key=repr)
    assert token_counts.token_counts(frame(spark, []), PIECE_BPE).count() == 0
