"""Small documents with every awkward case, beside columns whose names the operators use inside."""

import random
from pathlib import Path

import duckdb

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, predicted int, key long, anchor long, "
    "set_id long, bucket int, place string, text_key long, names string"
)
EXTRA = (0.5, 1, 7, 8, 9, 10, "p", 11, "n")


def row(doc_id, text, lang="en", source="src0"):
    return (doc_id, text, lang, source, len(text or ""), *EXTRA)


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def documents(seed=1, groups=25):
    """Groups of exact and near copies, shared passages, and the awkward rows."""
    rng = random.Random(seed)
    passage = words(rng, 70)
    rows, i = [], 0
    for _ in range(groups):
        base = words(rng, rng.choice([3, 4, 5, 8, 10, 14, 20, 30, 60, 150]))
        if rng.random() < 0.4:
            at = rng.randrange(len(base))
            base[at:at] = passage[rng.randrange(30) :]
        for _ in range(rng.choice([1, 1, 2, 3, 8])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                copy[rng.randrange(len(copy))] = f"w{rng.randrange(400)}"
            joined = rng.choice([" ", "\n", "  "]).join(copy)
            rows.append(row(i, joined.upper() if rng.random() < 0.2 else joined, rng.choice(["en", "de"]), f"src{rng.randrange(4)}"))
            i += 1
    rows += [
        row(9000, None), row(9001, ""), row(9002, " \n\t"), row(None, rows[0][1]), row(None, "only here"), row(9003, rows[2][1]),
        row(9004, "Héllo wörld 😀 ñandú", None, None), row(9005, "a", None), row(9006, "x" * 3000), row(9007, " ".join(["again"] * 200)),
        rows[3], rows[3], row(9008, " ".join(words(rng, 6000))),
    ]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def texts(rows):
    return [(r[0], r[1]) for r in rows]


def tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def in_duck(rows, sql):
    """The rows of DuckDB SQL over ``documents`` of these rows, by column name."""
    connection = duckdb.connect()
    connection.execute(
        "CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)"
    )
    if rows:
        connection.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", [r[:5] for r in rows])
    cursor = connection.execute(sql)
    columns = [c[0] for c in cursor.description]
    found = cursor.fetchall()
    connection.close()
    return columns, sorted(found, key=repr)


SF = Path("/root/testdata/sf0.001")
