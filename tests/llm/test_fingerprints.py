"""Winnowing fingerprints against a plain version."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.data import documents, frame, row, texts, tuples
from wardlake.llm import fingerprints as fp

ROWS = documents(seed=4, groups=10)


@pytest.mark.parametrize("n", [1, 5, 16, 17, 100, 700])
@pytest.mark.parametrize("window", [1, 4, 16])
def test_winnow_takes_the_rightmost_least(n, window):
    hashes = np.random.default_rng(n).integers(0, 6, n).astype(np.uint64) << np.uint64(40)
    width = min(window, n)
    expected = {max(j for j in range(i, i + width) if hashes[j] == hashes[i : i + width].min()) for i in range(n - width + 1)}
    assert fp.winnow(hashes, window).tolist() == sorted(expected)


def test_winnow_across_blocks(monkeypatch):
    hashes = np.random.default_rng(1).integers(0, 9, 500).astype(np.uint64) << np.uint64(40)
    whole = fp.winnow(hashes, 16).tolist()
    monkeypatch.setattr(fp, "_BLOCK", 64)
    assert fp.winnow(hashes, 16).tolist() == whole


def test_strings_hold_hashes_and_positions():
    hashes, places = fp.selected("the quick brown fox jumps over the lazy dog, again and again")
    assert [x.tolist() for x in fp.from_text(fp.to_text(hashes, places))] == [hashes.tolist(), places.tolist()]
    assert fp.to_text(*fp.selected("")) == ""


def test_shared_passages_are_found():
    passage = "a passage that both of the texts hold"  # longer than window + k - 1
    a, _ = fp.selected("one text has " + passage + " in it")
    b, _ = fp.selected("éé another 😀 one holds " + passage)
    assert len(passage) >= fp.WINDOW + fp.K - 1
    assert set(a.tolist()) & set(b.tolist())


def test_likeness():
    one, two = np.array([1, 2, 3, 4]), np.array([3, 4, 5, 6])
    assert fp.likeness(one, two) == 0.5 and fp.likeness(one, one) == 1.0
    assert fp.likeness(one[:0], one[:0]) == 1.0 and fp.likeness(one, one[:0]) == 0.0


def plain(rows):
    order = sorted(rows, key=lambda r: r[1] or "")
    order.sort(key=lambda r: (r[0] is None, -(r[0] or 0)))
    order = [(i, t or "") for i, t in order]
    out = []
    for at, (i, text) in enumerate(order):
        following = order[(at + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        mine, other, after = (fp.selected(t) for t in (text, edited, following))
        near = [fp.likeness(np.unique(mine[0]), np.unique(x[0])) for x in (other, after)]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), fp.to_text(*mine), fp.to_text(*other), *near))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


@pytest.mark.parametrize("buckets", [1, 7, 64])
def test_neighbours(spark, buckets):
    found = fp.fingerprint_neighbours(frame(spark, ROWS), buckets=buckets)
    assert found.columns == COLUMNS
    assert tuples(found, *COLUMNS) == plain(texts(ROWS))


@pytest.mark.parametrize("rows", [[], [row(5, "the only document there is")], [row(None, "a"), row(None, "b")]])
def test_neighbours_of_few(spark, rows):
    assert tuples(fp.fingerprint_neighbours(frame(spark, rows)), *COLUMNS) == plain(texts(rows))


@pytest.mark.parametrize("bounds", [[], [5], list(range(0, 100, 7))])
def test_buckets_count_bounds(spark, bounds):
    rows = spark.range(-2, 101).select("id", fp.bucket_of(F.col("id"), bounds).alias("bucket")).collect()
    assert [r["bucket"] for r in rows] == [sum(b <= r["id"] for b in bounds) for r in rows]


def test_fingerprints(spark):
    found = fp.fingerprints(frame(spark, ROWS)).select("fingerprint", "positions").collect()
    assert sorted(r["fingerprint"] for r in found) == sorted(fp.to_text(*fp.selected(t or "")) for _, t in texts(ROWS))
    assert all(len(r["positions"]) == len(r["fingerprint"]) // 6 for r in found)
