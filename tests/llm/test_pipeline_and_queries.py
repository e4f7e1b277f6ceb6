"""The pipeline stage by stage, and the registered queries."""

import random
from pathlib import Path

import duckdb
import numpy as np
import pytest
import sentencepiece

import __spark_entry__ as entry_point
import corpus_pipeline
from tests.llm.data import SF, documents, frame, in_duck, row, texts, tuples, words
from tests.llm.test_pairs_and_copies import plain_components
from wardlake.llm import common, mixing, toxicity
from wardlake.llm.queries import ORACLES, QUERIES
from wardlake.llm.sentencepiece_codec import codec


def test_all_are_registered():
    names = entry_point.queries()
    assert {f"op{i}_" for i in range(1, 14)} == {n[: n.index("_") + 1] for n in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for file in sorted(Path(SF).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    cursor = connection.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    expected = sorted(cursor.fetchall(), key=repr)
    df = QUERIES[name](spark, str(SF))
    assert sorted(df.columns) == sorted(columns)
    assert tuples(df, *columns) == expected


NATIVE = {"op4_exact_dedup", "op9_mix_sources", "op10_license_scan"}


@pytest.mark.parametrize("name", sorted(NATIVE))
def test_native_operators_run_no_python(spark, name):
    df = QUERIES[name](spark, str(SF))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))


def labels_folder(tmp_path, spark, rows):
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_stages_on_awkward_rows(spark, tmp_path):
    rows = documents(seed=8, groups=12)
    folder = labels_folder(tmp_path, spark, [(1, 1, 0), (2, 0, 1)])
    docs = frame(spark, rows)
    columns = docs.columns
    by_name = dict(corpus_pipeline.STAGES)
    assert list(by_name) == ["toxicity", "exact_dedup", "near_dedup", "mix_sources", "sentencepiece"]

    clean = by_name["toxicity"](spark, docs, folder)
    assert clean.columns == columns and clean.count() <= len(rows)

    near = by_name["near_dedup"](spark, docs, folder)
    components = plain_components(texts(rows), 4, 85)
    assert near.columns == columns
    assert [r[0] for r in tuples(near, "doc_id")] == sorted({c for _, _, c in components}, key=lambda i: repr((i,)))

    left = docs
    for name, stage in corpus_pipeline.STAGES[1:4]:
        left = stage(spark, left, folder)
        assert left.columns == columns, name
    mixed = left.collect()
    last = by_name["sentencepiece"](spark, left, folder)
    at_work = codec(corpus_pipeline.PIECE_BPE)
    expected = sorted(((r["doc_id"], at_work.encode([r["text"] or ""])[0][0]) for r in mixed), key=repr)
    assert sorted(((r["doc_id"], bytes(r["ids"])) for r in last.collect()), key=repr) == expected


def test_near_stage_takes_five_words_and_80_percent(spark, tmp_path):
    rows, pairs = [], 0
    for base in range(4):
        text = [f"b{base}w{i}" for i in range(300)]
        changed = [text, text[:250], text + [f"x{base}n{i}" for i in range(60)], text[:120] + [f"y{base}n{i}" for i in range(28)] + text[148:]]
        rows += [row(10 * base + k, " ".join(changed[k])) for k in (0, base)]
        pairs += base > 0
    by_name = dict(corpus_pipeline.STAGES)
    kept = [r[0] for r in tuples(by_name["near_dedup"](spark, frame(spark, rows), str(tmp_path)), "doc_id")]
    assert kept == [0, 10, 20, 30]
    assert kept == sorted({c for _, _, c in plain_components(texts(rows), 5, 80)})
    assert len({c for _, _, c in plain_components(texts(rows), 4, 85)}) == len(kept) + pairs


def test_near_stage_keeps_one_row_under_null_and_repeated_ids(spark, tmp_path):
    def near(name, i):
        return " ".join([f"{name}{j}" for j in range(60)] + [f"end{i}"])

    rows = [row(None, near("n", i)) for i in range(4)]  # near copies without an id
    rows += [row(7, near("r", i)) for i in range(3)] + [row(8, near("r", 0))]  # and under the least id
    rows += [row(None, near("n", 0)), row(None, None), row(None, ""), row(9, near("s", 0)), row(None, near("s", 1))]
    by_name = dict(corpus_pipeline.STAGES)
    kept = tuples(by_name["near_dedup"](spark, frame(spark, rows), str(tmp_path)), "doc_id", "text")
    assert sorted((i is None, i or 0, (t or "")[:1]) for i, t in kept) == [(False, 7, "r"), (False, 9, "s"), (True, 0, ""), (True, 0, "n")]


def test_stages_on_an_empty_table(spark, tmp_path):
    folder = labels_folder(tmp_path, spark, [])
    docs = frame(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.count() == 0, name
        docs = out if name != "sentencepiece" else docs


def plain_toxicity(spark, docs, folder):
    """A score of every row by the learned scorer, one text at a time."""
    rows = docs.select("doc_id", "text").fillna("", "text")
    scorer = toxicity.learn(rows, toxicity.labelled(spark.read.parquet(f"{folder}/labels.parquet")))
    reader = toxicity.Reader(scorer.lexicon)
    return lambda text: scorer.score(reader.clauses(text or ""))


def test_run_equals_plain_stages(spark, tmp_path):
    rng = random.Random(5)
    rows = documents(seed=8, groups=12)
    for i in range(160):
        rows.append(row(20_000 + i, " ".join(words(rng, 12) + ["zorgon"] * (i % 4 == 0)), source=f"src{i % 4}"))
    folder = labels_folder(tmp_path, spark, [(20_000 + i, 1, int(i % 4 == 0)) for i in range(160)])
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")

    score = plain_toxicity(spark, docs, folder)
    left = [r for r in rows if score(r[1]) < toxicity.THRESHOLD]
    assert 0 < len(left) < len(rows)
    staged = corpus_pipeline.STAGES[0][1](spark, docs, folder)
    assert tuples(staged, "doc_id", "text") == sorted(texts(left), key=repr)

    copies = {}
    for r in left:
        key = (r[1] or "").encode().lower()
        if key not in copies or (r[0] is not None and (copies[key][0] is None or r[0] > copies[key][0])):
            copies[key] = r
    stay = {least for _, _, least in plain_components(texts(copies.values()), 5, 80)}
    near = [r for r in copies.values() if r[0] in stay]
    columns, mixed = in_duck(near, mixing.oracle(corpus_pipeline.ONE_EPOCH))
    taken = {r[columns.index("doc_id")] for r in mixed if r[columns.index("copies")] > 0}
    library, kind = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.PIECE_BPE), codec(corpus_pipeline.PIECE_BPE).kind
    expected = sorted(((r[0], library.encode(r[1] or "")) for r in near if r[0] in taken), key=repr)
    found = corpus_pipeline.run(spark, folder).collect()
    assert 0 < len(expected) < len(near) < len(copies) < len(left)
    assert sorted(((r["doc_id"], np.frombuffer(r["ids"], kind).tolist()) for r in found), key=repr) == expected


def test_run_takes_every_stage(spark):
    found = corpus_pipeline.run(spark, str(SF))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = spark.createDataFrame(stage(spark, before, str(SF)).collect(), docs.schema)
        assert kept.count() <= before.count(), name
    assert 0 < kept.count() < docs.count()
    assert [r[0] for r in tuples(found, "doc_id")] == [r[0] for r in tuples(kept, "doc_id")]
    tokens = {r["doc_id"]: r["n_tokens"] for r in mixing.measured(kept, mixing.PRODUCTION).collect()}
    assert set(tokens) == {r["doc_id"] for r in found.collect()}


def test_workers_keep_no_free_memory_after_a_task():
    """Blocks below one that is still in use stay with the process unless they are given back."""

    def resident():
        status = Path("/proc/self/status").read_text()
        return int(status.split("VmRSS:")[1].split()[0]) // 1024

    kept = []

    def work(batches):
        for n in batches:
            blocks = []
            for _ in range(n):  # 96 KB each, from the heap
                blocks.append(np.ones(12_000))
                kept.append(np.ones(1_000))
            yield len(blocks)

    before = resident()
    assert list(common.tidy(work)([2_000])) == [2_000]
    assert resident() < before + 60
