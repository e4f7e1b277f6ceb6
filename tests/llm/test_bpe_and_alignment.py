"""The BPE codec against the library, and token alignment against all overlaps of a document."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tests.llm.data import documents, frame, row, texts, tuples
from tests.llm.test_tokens import odd_texts
from wardlake.llm import bpe_codec, token_alignment

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
ROWS = documents(seed=12, groups=8)
ODD = [
    *odd_texts(120, seed=3), "", " ", "photography,x", "Σας ΟΔΟΣ\x85a\x1cb", "<|endoftext|> x<|startoftext|>y", "a" * 999, "日本語テキスト",
    "é é ́x", "İ ǅ ﬁ µ ª", "a'll 's'S don't I'LL", " x  y", "<|endoftext|", "x\x00y\x7f", "😀😀!?", "1234 5", "ab" * 3000, "Straße ÀÖß×÷ÿ",
]


@pytest.fixture(params=[WORD_BPE, BYTE_BPE], ids=["word", "byte"])
def vocabulary(request):
    return request.param


def test_ids_and_text_are_the_library_s(vocabulary):
    library, codec = Tokenizer.from_file(vocabulary), bpe_codec.Codec(vocabulary)
    for text, data in zip(ODD, codec.encode(ODD)):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(data, "<u4").tolist() == ids
        assert codec.decode(data) == library.decode(ids, skip_special_tokens=False)


_WORD = bpe_codec.Codec(WORD_BPE), Tokenizer.from_file(WORD_BPE)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    codec, library = _WORD
    assert np.frombuffer(codec.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def plain_merges(word, ranks):
    while True:
        found = [(ranks[p], k) for k, p in enumerate(zip(word, word[1:])) if p in ranks]
        if not found:
            return word
        _, k = min(found)
        word = [*word[:k], word[k] + word[k + 1], *word[k + 2 :]]


def test_merges_in_any_order():
    """Invented vocabularies, also such whose products are parts of pairs of lower rank."""
    rng = random.Random(1)
    unsafe = 0
    for _ in range(150):
        tokens, merges = list("abc"), []
        while len(merges) < 12:
            pair = (rng.choice(tokens), rng.choice(tokens))
            if pair not in merges and len("".join(pair)) <= 6:
                merges.append(pair)
                tokens += [t for t in ["".join(pair)] if t not in tokens]
        rng.shuffle(merges)
        vocabulary = {t: i for i, t in enumerate(tokens)}
        table = bpe_codec.Merges(vocabulary, merges)
        unsafe += int(table.one_by_one.any())
        words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 25))) for _ in range(20)]
        symbols = np.array([vocabulary[c] for w in words for c in w], dtype=np.int64)
        found = table.encode(symbols, np.array([len(w) for w in words]))
        ranks = {p: r for r, p in enumerate(merges)}
        for word, data in zip(words, found):
            assert [tokens[i] for i in np.frombuffer(data, "<u4")] == plain_merges(list(word), ranks)
    assert unsafe


def test_cache_may_be_full(monkeypatch):
    monkeypatch.setattr(bpe_codec, "CACHE_WORDS", 3)
    codec = bpe_codec.Codec(WORD_BPE)
    assert codec.encode(["a b c d"] * 2) == codec.encode(["a b c d"] * 2) == _WORD[0].encode(["a b c d"] * 2)


def test_other_vocabularies_raise(tmp_path):
    with pytest.raises(ValueError):
        path = tmp_path / "t.json"
        path.write_text('{"model": {"type": "WordPiece"}, "pre_tokenizer": null, "added_tokens": []}')
        bpe_codec.Codec(str(path))


def test_codec_rows(spark, vocabulary):
    library = Tokenizer.from_file(vocabulary)
    expected = []
    for doc_id, text in texts(ROWS):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        hashes = [hashlib.sha256(b).hexdigest() for b in (np.array(ids, "<u4").tobytes(), decoded.encode())]
        expected.append((doc_id, len(ids), *hashes))
    found = bpe_codec.bpe_codec(frame(spark, ROWS), vocabulary)
    assert tuples(found, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(expected, key=repr)
    assert bpe_codec.bpe_codec(frame(spark, []), vocabulary).count() == 0
    back = bpe_codec.bpe_decode(bpe_codec.bpe_encode(frame(spark, ROWS), vocabulary), vocabulary)
    assert sorted(hashlib.sha256(r.text.encode()).hexdigest() for r in back.collect()) == sorted(e[3] for e in expected)


def spans(pieces):
    ends = np.cumsum([len(p) for p in pieces]).tolist()
    return list(zip([0, *ends], ends))


def plain_alignment(rows):
    """Every pair of tokens of a document is tried for an overlap."""
    a_library = Tokenizer.from_file(BYTE_BPE)
    a_library.encode_special_tokens = True
    b_library = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    letters = token_alignment.byte_letters()
    found, held = [], Counter()
    for doc_id, text in rows:
        text = text or ""
        a = a_library.encode(" " + text, add_special_tokens=False).ids
        b = b_library.encode(text)
        a_bytes = [bytes(letters[c] for c in a_library.id_to_token(i)) for i in a]
        b_bytes = [
            bytes([int(p[3:5], 16)]) if b_library.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, b_library.id_to_piece(b))
        ]
        if not text or b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            found.append((doc_id, [], [], [], ""))
            continue
        a_spans, b_spans = spans(a_bytes), spans(b_bytes)
        starts = defaultdict(list)  # of B's tokens by the bytes they cover
        for j, (begin, end) in enumerate(b_spans):
            for at in range(begin, end):
                starts[at].append(j)
        links = [(a[i], b[j]) for i, (begin, end) in enumerate(a_spans) for j in sorted({j for at in range(begin, end) for j in starts[at]})]
        cuts = sorted({e for _, e in a_spans} & {e for _, e in b_spans})
        groups, low = [], 0
        for cut in cuts:
            sides = [",".join(str(i) for i, (s, e) in zip(ids, where) if low <= s and e <= cut) for ids, where in ((a, a_spans), (b, b_spans))]
            groups.append("|".join(sides))
            low = cut
        held.update(set(links))
        found.append((doc_id, a, b, links, ";".join(groups)))
    most = Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    return sorted(
        (
            (
                doc_id, len(a), len(b), groups.count(";") + 1 if groups else 0, len(links), sum(held[p] == most[p[0]] for p in links),
                sum(held[p] for p in links), hashlib.sha256(groups.encode()).hexdigest() if groups else "",
            )
            for doc_id, a, b, links, groups in found
        ),
        key=repr,
    )


@pytest.mark.parametrize("pack_bytes, segment", [(4_000_000, 1_024), (300, 7)])
def test_alignment(spark, pack_bytes, segment):
    rows = [r for r in ROWS if len(r[1] or "") < 5000] + [row(20_000 + i, t) for i, t in enumerate(ODD) if len(t) < 2500]
    found = token_alignment.token_alignment(frame(spark, rows), BYTE_BPE, PIECE_BPE, pack_bytes=pack_bytes, segment=segment)
    assert tuples(found, *token_alignment.OUT.names) == plain_alignment(texts(rows))


def test_alignment_of_nothing(spark):
    assert token_alignment.token_alignment(frame(spark, []), BYTE_BPE, PIECE_BPE).count() == 0
    found = token_alignment.token_alignment(frame(spark, [row(1, None), row(1, ""), row(None, "▁")]), BYTE_BPE, PIECE_BPE)
    zeros = (0,) * 6 + ("",)
    assert tuples(found, *token_alignment.OUT.names) == sorted([(1, *zeros), (1, *zeros), (None, *zeros)], key=repr)


def test_tokens_of_a_are_the_library_s():
    """tiktoken with the vocabulary's ids as ranks gives the ids of the tokenizers library."""
    pair = token_alignment.tokenizers(BYTE_BPE, PIECE_BPE)
    library = Tokenizer.from_file(BYTE_BPE)
    library.encode_special_tokens = True
    rng = random.Random(4)
    some = [" " + "".join(chr(rng.choice([rng.randrange(32, 0x250), rng.randrange(0x250, 0xD800), rng.randrange(0x1F000, 0x20000)])) for _ in range(40)) for _ in range(500)]
    for text in [*some, *(" " + t for t in ODD)]:
        assert pair.a.encode_ordinary(text) == library.encode(text, add_special_tokens=False).ids
