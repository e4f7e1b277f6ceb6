"""The Merkle manifest against a plain tree."""

import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from tests.llm.data import documents, frame, in_duck, row, tuples
from wardlake.llm import merkle_manifest as merkle

COLUMNS = merkle.ROWS.names


def digest(text):
    return sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def plain(rows):
    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars in (r[:5] for r in rows):
        head = field(doc_id) + field(source) + field(lang) + field(n_chars)
        altered = None
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
            altered = digest(head + field(lower(text)))
        groups[source].append((doc_id is not None, doc_id or 0, digest(head + field(text)), doc_id, altered))
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    found = []
    for k, source in enumerate(sources):
        for i, (_, _, leaf, doc_id, altered) in enumerate(sorted(groups[source], key=lambda x: x[:3])):
            node, proof = altered or leaf, ""
            for levels, at in ((trees[source], i), (top, k)):
                for level in levels[:-1]:
                    run, j = level[at // 16 * 16 : at // 16 * 16 + 16], at % 16
                    proof += "".join(run[:j] + run[j + 1 :])
                    node, at = digest("".join([*run[:j], node, *run[j + 1 :]])), at // 16
            root = top[-1][0]
            found.append((doc_id, leaf, trees[source][-1][0], root, digest(proof), node, node == root))
    return sorted(found, key=repr)


def many():
    """More than a chunk of one row, ids that repeat with other texts, no ids, negative and far ids, many sources."""
    rows = documents(seed=3)
    rows += [row(None, f"No id {i}", source="src1") for i in range(300)]
    rows += [row(77, "Same")] * 5000 + [row(77, f"Other {i % 50}") for i in range(100)]
    rows += [row(-5 - i * 1000, "Below zero") for i in range(40)]
    return rows + [row((1 << 62) + i, "Far", source=f"s{i:03}é") for i in range(300)]


@pytest.mark.parametrize("rows", [documents(seed=5, groups=6), many()], ids=["awkward", "repeated"])
def test_equals_a_plain_tree(spark, rows):
    found = tuples(merkle.merkle_manifest(frame(spark, rows)), *COLUMNS)
    assert found == plain(rows)
    assert {True, False} == {r[-1] for r in found}


def test_small_chunks_take_several_rounds(monkeypatch):
    """Chunks of 16 slots and one level, in this process: the same tree through more rounds."""
    monkeypatch.setattr(merkle, "CHUNK", 16)
    monkeypatch.setattr(merkle, "LEVELS", 1)
    leaves = [digest(str(i)) for i in range(600)]
    nodes, level = leaves, 0
    while len(nodes) > 1:
        nodes = [merkle.levels_of(nodes[c * 16 : c * 16 + 16], len(nodes))[-1][0] for c in range(-(-len(nodes) // 16))]
        level += 1
    assert [nodes] == tree(leaves)[-1:] and level == 3


def test_rounds_of_a_large_tree(spark):
    """A tree of more than one chunk, by its own chunk tables."""
    n = 3 * merkle.CHUNK + 5
    rows = [row(i, f"Text {i}", source="one") for i in range(n)]
    assert tuples(merkle.merkle_manifest(frame(spark, rows)), *COLUMNS) == plain(rows)


def test_one_row_and_none(spark):
    rows = [row(5, None, None, None)]
    assert tuples(merkle.merkle_manifest(frame(spark, rows)), *COLUMNS) == plain(rows)
    assert merkle.merkle_manifest(frame(spark, [])).count() == 0


def test_sql_equals_the_plain_tree():
    rows = documents(seed=4)
    columns, found = in_duck(rows, merkle.ORACLE)
    assert sorted((tuple(r[columns.index(c)] for c in COLUMNS) for r in found), key=repr) == plain(rows)


def test_lost_leaves_are_noticed(spark):
    import pyarrow as pa

    entries = pa.array([{"slot": 0, "run": 1, "leaf": "a"}, {"slot": 0, "run": 1, "leaf": "b"}])
    with pytest.raises(ValueError):
        merkle.slot_array(entries, "leaf", 3, 0)
