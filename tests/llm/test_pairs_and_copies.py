"""Substring dedup, exact dedup and the Jaccard join against brute force."""

import hashlib
import random
import uuid
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.data import documents, frame, in_duck, row, texts, tuples
from wardlake.llm import components, exact_dedup, jaccard_join, substring_dedup

ROWS = documents()


def plain_substrings(rows, window):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    seen = Counter(tuple(w[a : a + window]) for _, w in split for a in range(len(w) - window + 1))
    out = []
    for i, w in split:
        gone = {
            a + j for a in range(len(w) - window + 1) if seen[tuple(w[a : a + window])] > 1 for j in range(window)
        }
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot, shard_words", [(64, 60_000), (1, 300)])
def test_substring_dedup(spark, hot, shard_words):
    found = substring_dedup.substring_dedup(frame(spark, ROWS), window=12, gram=5, hot=hot, shard_words=shard_words)
    expected = plain_substrings(texts(ROWS), 12)
    assert tuples(found, "doc_id", "n_words", "n_removed", "kept_sha256") == expected
    assert any(0 < removed < n for _, n, removed, _ in expected)


def test_substring_dedup_of_nothing(spark):
    found = substring_dedup.substring_dedup(frame(spark, []))
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert found.count() == 0


def test_automaton_counts_every_run():
    sequences = [(b"a b c a b".split(), 2), (b"b c a".split(), 1), (b"a b".split(), 3)]
    automaton = substring_dedup.SuffixAutomaton()
    for sequence, weight in sequences:
        automaton.add(sequence, weight)
    automaton.finish()
    for k in (1, 2, 3):
        runs = Counter()
        for sequence, weight in sequences:
            for a in range(len(sequence) - k + 1):
                runs[tuple(sequence[a : a + k])] += weight
        for sequence, _ in sequences:
            assert dict(automaton.matches(sequence, k)) == {
                a: runs[tuple(sequence[a : a + k])] for a in range(len(sequence) - k + 1)
            }


def test_equal_windows_have_one_anchor():
    rng = np.random.default_rng(3)
    shared = rng.integers(0, 5, 60).astype(np.uint64)
    places = []
    for before in (0, 7, 40):
        hashes = np.concatenate((rng.integers(5, 9, before).astype(np.uint64), shared))
        place, first, last = substring_dedup.anchored(hashes, 20, 6)
        anchor = {w: p for p, a, b in zip(place, first, last) for w in range(a, b + 1)}
        assert sorted(anchor) == list(range(len(hashes) - 19))
        places.append([anchor[before + w] - before for w in range(41)])
    assert places[0] == places[1] == places[2]


def test_exact_dedup_equals_its_sql(spark):
    columns, expected = in_duck(ROWS, exact_dedup.ORACLE)
    assert tuples(exact_dedup.exact_dedup(frame(spark, ROWS)), *columns) == expected


def test_exact_dedup_renames_when_names_clash(spark, monkeypatch):
    salts = []

    def clashes_once(docs, light, salt, levels):
        salts.append(salt)
        return salt == 0

    monkeypatch.setattr(exact_dedup, "same_name", clashes_once)
    exact_dedup.exact_dedup(frame(spark, ROWS[:5])).count()
    assert salts == [0, 1]


def test_a_weak_hash_still_gives_right_groups(spark, monkeypatch):
    """20 bits for some hundred blocks and pairs: clashes are found and another salt is taken, or it is an error."""
    strong, salts = exact_dedup.name_of, []
    monkeypatch.setattr(exact_dedup, "name_of", lambda salt, *more: salts.append(salt) or F.substring(strong(salt, *more), 1, 2))
    columns, expected = in_duck(ROWS, exact_dedup.ORACLE)
    assert tuples(exact_dedup.exact_dedup(frame(spark, ROWS)), *columns) == expected
    monkeypatch.setattr(exact_dedup, "name_of", lambda *more: F.lit(b"x"))
    with pytest.raises(RuntimeError):
        exact_dedup.exact_dedup(frame(spark, ROWS[:9]))


def test_a_third_of_all_rows_may_be_copies_without_an_id(spark):
    rows = [row(None, "Same")] * 300 + [row(i, f"text {i}") for i in range(50)] + [row(None, "same")] * 3
    columns, expected = in_duck(rows, exact_dedup.ORACLE)
    found = exact_dedup.exact_dedup(frame(spark, rows))
    assert tuples(found, *columns) == expected
    assert "Window" not in found._jdf.queryExecution().toString()


def test_two_blocks_with_one_name_are_found(spark):
    docs = frame(spark, [row(1, "a" * 5000), row(2, "b" * 9000)]).select("doc_id", "text")
    light = exact_dedup.named(docs, 0, 2)
    assert not exact_dedup.same_name(docs, light, 0, 2)
    names = light.select("names").collect()
    assert [len(set(r["names"])) for r in sorted(names, key=lambda r: len(r["names"]))] == [2, 2]  # 4096 equal bytes, and the rest


def test_drop_copies_keeps_rows_whole(spark):
    docs = frame(spark, ROWS)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    groups = defaultdict(list)
    for i, t in texts(ROWS):
        groups[(t or "").encode().lower()].append(i)
    expected = sorted((max((i for i in ids if i is not None), default=None) for ids in groups.values()), key=repr)
    assert [r[0] for r in tuples(kept, "doc_id")] == expected
    assert exact_dedup.drop_copies(frame(spark, [])).count() == 0


def test_drop_copies_takes_case_variants_of_one_id_once(spark):
    rows = [row(1, "A b"), row(1, "a B"), row(1, "a B"), row(2, None), row(2, ""), row(None, "C"), row(None, "c"), row(3, "A")]
    docs = frame(spark, rows)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert [(i, (t or "").lower()) for i, t in tuples(kept, "doc_id", "text")] == [(1, "a b"), (2, ""), (3, "a"), (None, "c")]
    assert kept.count() == exact_dedup.exact_dedup(docs).where("kept").count()


def plain_components(rows, gram, percent):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(w[a : a + gram]) for a in range(max(1, len(w) - gram + 1))) if w else frozenset())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                parent[find(a)] = find(b)
    ids = defaultdict(list)
    for a, (i, _) in enumerate(rows):
        ids[find(a)].append(i)
    least = {r: min((i for i in group if i is not None), default=None) for r, group in ids.items()}
    return sorted(((i, len(sets[a]), least[find(a)]) for a, (i, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("chance, cell, sketch", [(0.03, 4_000, 16), (0.9, 2, 1)])
def test_jaccard_join(spark, monkeypatch, chance, cell, sketch):
    monkeypatch.setattr(jaccard_join, "CHANCE", chance)
    monkeypatch.setattr(jaccard_join, "CELL", cell)
    monkeypatch.setattr(jaccard_join, "SKETCH", sketch)
    monkeypatch.setattr(jaccard_join, "MEMBERS_PER_SALT", 3)
    found = jaccard_join.jaccard_components(frame(spark, ROWS))
    expected = plain_components(texts(ROWS), 4, 85)
    assert tuples(found, "doc_id", "n_shingles", "component_id") == expected
    assert any(c is not None and c != i for i, _, c in expected)


def test_rows_of_one_id_do_not_meet_every_set_of_it(spark, monkeypatch, tmp_path):
    rows = []
    for i in range(30):
        text = [f"s{i}w{j}" for j in range(40)]
        rows += [row(None, " ".join(text)), row(None, " ".join([*text, "end"]))]
    plain = jaccard_join.chosen_sets

    def counted(gram, shared):
        choose = plain(gram, shared)

        def count(batches):
            for batch in batches:
                (tmp_path / uuid.uuid4().hex).write_text(str(len(batch)))
                yield from choose(iter([batch]))

        return count

    monkeypatch.setattr(jaccard_join, "chosen_sets", counted)
    found = jaccard_join.jaccard_components(frame(spark, rows))
    assert tuples(found, "doc_id", "n_shingles", "component_id") == plain_components(texts(rows), 4, 85)
    assert sum(int(f.read_text()) for f in tmp_path.iterdir()) == len(rows)


def around_the_threshold(n, seed=5):
    """One text and n copies with 6 to 9 of 100 words changed, of which some link with some."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(100)]
    rows = [row(0, " ".join(base))]
    for i in range(1, n + 1):
        copy = list(base)
        for at in rng.sample(range(0, 100, 5), rng.randrange(1, 4)):
            copy[at] = f"c{i}x{at}"
        rows.append(row(i, " ".join(copy)))
    return rows


def test_rounds_do_not_grow_with_sets_that_do_not_link(spark, monkeypatch):
    """Texts that share a passage, and so signatures, but are not alike."""
    tables = {}
    for module in (jaccard_join, components):
        plain = module.written
        monkeypatch.setattr(module, "written", lambda df, name, plain=plain: tables[n].append(name) or plain(df, name))
    passage = [f"p{i}" for i in range(60)]
    for n in (6, 12, 100):
        tables[n] = []
        rows = [row(i, " ".join([*passage, *(f"d{i}w{j}" for j in range(30))])) for i in range(n)]
        found = jaccard_join.jaccard_components(frame(spark, rows))
        assert tuples(found, "doc_id", "n_shingles", "component_id") == plain_components(texts(rows), 4, 85)
    assert "left" in tables[100]  # groups of several components there were
    assert len(tables[6]) == len(tables[12]) == len(tables[100])


def test_a_pair_comes_out_once(spark):
    """Members that share many signatures; the join's rows are its pairs."""
    rng = np.random.default_rng(2)
    shapes = ", ".join(f"p{i} long" for i in range(jaccard_join.PARITY_WORDS))
    rows = [
        (int(s), x, x // 20, 40, 20, 0, 10, *[0] * jaccard_join.PARITY_WORDS) for x in range(40) for s in rng.permutation(60)[:50]
    ]
    members = spark.createDataFrame(rows, f"signature long, set_id long, root long, n_members long, n_minor long, main long, n long, {shapes}")
    found = jaccard_join.across(members, jaccard_join.may_link(85))
    assert tuples(found, "a", "b") == sorted(((a, b) for a in range(20) for b in range(20, 40)), key=repr)


def allocation(spark, monkeypatch, rows, **shape):
    """The bands that sets were sent by, those with a set of their size."""
    taken, plain = [], jaccard_join.signature_rows
    monkeypatch.setattr(jaccard_join, "signature_rows", lambda gram, percent, allocated, shared: taken.append(allocated) or plain(gram, percent, allocated, shared))
    found = jaccard_join.jaccard_components(frame(spark, rows), **shape)
    sizes = {n for _, n, _ in tuples(found, "doc_id", "n_shingles", "component_id")}
    return found, [b for b in taken[0] if any(b.low <= n <= b.high for n in sizes)]


def test_many_unlike_texts_are_sent_without_neighbourhoods(spark, monkeypatch):
    """What is sent for a text follows from what texts have in common, not from their number."""
    rows = [row(i, " ".join(f"d{i}w{j}" for j in range(60))) for i in range(8_000)]
    found, sent = allocation(spark, monkeypatch, rows, gram=5, percent=80)
    assert [b.neighbours for b in sent] == [False]
    assert found.where("component_id <> doc_id").count() == 0


def test_texts_that_share_a_passage_are_sent_with_neighbourhoods(spark, monkeypatch):
    passage = [f"p{j}" for j in range(50)]
    rows = [row(i, " ".join([*passage, *(f"d{i % 590}w{j}" for j in range(60)), *["end"] * (i // 590)])) for i in range(600)]
    found, sent = allocation(spark, monkeypatch, rows)
    assert any(b.neighbours for b in sent)
    assert tuples(found, "doc_id", "n_shingles", "component_id") == plain_components(texts(rows), 4, 85)


def test_copies_around_the_threshold(spark):
    rows = around_the_threshold(60)
    found = jaccard_join.jaccard_components(frame(spark, rows))
    assert tuples(found, "doc_id", "n_shingles", "component_id") == plain_components(texts(rows), 4, 85)


def test_sets_of_one_name_go_by_both(spark):
    sets = spark.createDataFrame([(3, 7, 1), (3, 7, 1), (3, 7, 2), (3, 8, 4), (0, 9, 5), (0, 9, 6)], "n_shingles long, set_id long, check_id long")
    assert jaccard_join.shared_names(sets) == {7}
    items = np.array([5, 6, 7], dtype=np.uint64)
    first, second = jaccard_join.set_ids(items)
    assert jaccard_join.set_name(items, frozenset()) == first
    assert jaccard_join.set_name(items, frozenset([first])) == first ^ second


def test_jaccard_join_of_nothing(spark):
    assert jaccard_join.jaccard_components(frame(spark, [])).count() == 0
    bare = jaccard_join.jaccard_components(frame(spark, [row(5, None), row(6, "")]))
    assert tuples(bare, "doc_id", "n_shingles", "component_id") == [(5, 0, 5), (6, 0, 6)]


@pytest.mark.parametrize("sets", [0, 10**15])  # plain segments, and one-deletion neighbourhoods
def test_linked_sets_share_a_signature(sets):
    rng = np.random.default_rng(7)
    allocated = [jaccard_join.allocate(b, sets) for b in jaccard_join.bands(300, 85)]
    tried = 0
    for _ in range(1500):
        size = int(rng.choice([6, 7, 8, 9, 11, 12, 14, 20, 33, 60, 130]))
        a = rng.integers(0, 2**62, size).astype(np.uint64)
        differ = int(rng.integers(1, 15 * 2 * size // 185 + 2))
        drop = int(rng.integers(0, differ + 1))
        b = np.concatenate((a[drop:], rng.integers(0, 2**62, differ - drop).astype(np.uint64)))
        a, b = np.unique(a), np.unique(b)
        if jaccard_join.linked(a, b, 85):
            tried += 1
            mine, other = (set(jaccard_join.signatures(x, allocated, 85).tolist()) for x in (a, b))
            assert mine & other
    assert tried > 300


def test_bitmaps_never_rule_out_a_link():
    rng = np.random.default_rng(11)
    for _ in range(300):
        size = int(rng.choice([6, 20, 150, 900, 4000]))
        a = np.unique(rng.integers(0, 2**62, size).astype(np.uint64))
        drop = int(rng.integers(0, max(2, size // 5)))
        b = np.unique(np.concatenate((a[drop:], rng.integers(0, 2**62, int(rng.integers(0, drop + 2))).astype(np.uint64))))
        bits = int(np.bitwise_count((jaccard_join.parities(a) ^ jaccard_join.parities(b)).view(np.uint64)).sum())
        assert bits <= len(np.setxor1d(a, b))
