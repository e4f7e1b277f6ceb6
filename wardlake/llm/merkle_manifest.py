"""Operator 11: a Merkle tree over the rows of a table, leaf places by ranks in bitmaps.

A row's leaf is a hash of its columns. The leaves of a group (a source) stand in the order of
their ids and are reduced 16 at a time to the group's root; the groups' roots, in the order of the groups,
are reduced likewise to the root of the table.

A leaf's place is a rank query. Ids fall into buckets of ``BUCKET``; a bucket's bitmap is kept as its
64-bit words that are not empty, each merged from the map tasks' bits by ``bit_or``, with a directory of
the rows before each word. A row's place is the rows of the group's buckets before its own, the
rows before its word, and the bits below its own in that word. Leaves are never sorted for it; what
is sorted is one row per bucket. Rows without an id are ranked by the leading digits of their leaf in
the same way. Only words with more rows than bits (an id occurs again) need an order by leaf: their rows
are folded to distinct ones with a number of copies, and these are range-sorted.

Places are dealt into chunks of ``CHUNK`` slots. A chunk's rows fill its slot array by place and are reduced
three levels to one node, the next chunks hold those nodes, until one is left: a group of
10^12 rows takes four rounds, and a task sees a chunk at a time. On the way back
each chunk receives the siblings above it, so every row gets its whole proof within its chunk.

Defined cases: leaves of a group ascend by id, NULL first, then by leaf; repeated rows are leaves of
their own, side by side; a NULL group is a group, the first one; NULL columns hash as ``-``; a NULL id is
never tampered with; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from wardlake.llm.common import ascii_lower, workers_import, written

FAN = 16
LEVELS = 3
CHUNK = FAN**LEVELS
WORD_BITS = 6
BUCKET_BITS = 12
ID_DIGITS = 15  # leading hexadecimal digits of a leaf that rank rows without an id


def leaf_hash(columns: list[Column]) -> Column:
    """The hash of columns as text, each with its size in bytes, ``-`` for NULL."""
    parts = []
    for c in columns:
        value = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def tamper_flag(doc_id: Column, every: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % every == 0, F.lit(False))


def leaves_of(docs: DataFrame, id_col: str, group_col: str, columns: list[str], text_col: str, every: int) -> DataFrame:
    """tree, doc_id, leaf, tampered (NULL: not tampered with) and the bitmap coordinates of every row."""
    doc_id, group = docs[id_col].cast("long"), docs[group_col].cast("string")
    altered = [ascii_lower(docs[c].cast("string")) if c == text_col else docs[c] for c in columns]
    named = docs.select(
        # A group's name behind an s; the NULL group is the empty string and sorts first.
        F.coalesce(F.concat(F.lit("s"), group), F.lit("")).alias("tree"),
        doc_id.alias("doc_id"),
        leaf_hash([docs[c] for c in columns]).alias("leaf"),
        F.when(tamper_flag(doc_id, every), leaf_hash(altered)).alias("tampered"),
    )
    digits = F.conv(F.substring("leaf", 1, ID_DIGITS), 16, 10).cast("long")
    key = F.coalesce("doc_id", digits)
    return named.select(
        "*",
        F.col("doc_id").isNotNull().alias("has_id"),
        F.shiftright(key, BUCKET_BITS).alias("bucket"),
        (F.shiftright(key, WORD_BITS).bitwiseAND(F.lit((1 << BUCKET_BITS - WORD_BITS) - 1))).cast("int").alias("word"),
        key.bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int").alias("bit"),
    )


def running_start(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """``df`` with ``start``, the sum of ``value`` over all rows before in the order of ``keys``.

    A range sort; ranges are totalled first, then each adds up its own rows.
    """
    ranged = written(df.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()), name)
    totals = ranged.groupBy("part").agg(F.sum(value).alias("total"))
    so_far = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("part", F.coalesce(F.sum("total").over(so_far), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.withColumn("before", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(totals, "part")
        .withColumn("start", F.col("offset") + F.col("before"))
        .drop("part", "offset", "before")
    )


BUCKET_KEYS = ["tree", "has_id", "bucket"]


def bitmaps(leaves: DataFrame) -> DataFrame:
    """One row per bucket: its words, their bits, their rows and the rows before each."""
    one_bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
    words = leaves.groupBy(*BUCKET_KEYS, "word").agg(F.bit_or(one_bit).alias("bits"), F.count("*").alias("rows"))
    found = words.groupBy(*BUCKET_KEYS).agg(
        F.sort_array(F.collect_list(F.struct("word", "bits", "rows"))).alias("words"), F.sum("rows").alias("rows")
    )
    before = F.aggregate(
        "words",
        F.array(F.lit(0).cast("long")),
        lambda sums, w: F.concat(sums, F.array(F.element_at(sums, -1) + w["rows"])),
    )
    return found.withColumn("rows_before", before)


def placed(directory: DataFrame) -> DataFrame:
    """The directory with ``first``, a bucket's first place in its tree, and ``n``, the tree's leaves."""
    started = written(running_start(directory, BUCKET_KEYS, "rows", "buckets"), "directory")
    trees = started.groupBy("tree").agg(F.min("start").alias("tree_start"), F.sum("rows").alias("n"))
    return started.join(trees, "tree").withColumn("first", F.col("start") - F.col("tree_start")).drop("start", "tree_start", "rows")


def ranked(leaves: DataFrame, directory: DataFrame) -> DataFrame:
    """Every leaf with the place the bitmaps give it; ``crowded`` where only its word's place is known."""
    at = F.array_position(F.col("words.word"), F.col("word")).cast("int")
    bits, rows = F.element_at("words.bits", at), F.element_at("words.rows", at)
    below = bits.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), F.col("bit"))))
    word_place = F.col("first") + F.element_at("rows_before", at)
    crowded = rows != F.bit_count(bits)
    return leaves.join(directory, BUCKET_KEYS).select(
        "tree", "n", "doc_id", "leaf", "tampered", crowded.alias("crowded"),
        F.when(crowded, word_place).otherwise(word_place + F.bit_count(below)).alias("place"),
    )


def slots(leaves: DataFrame, directory: DataFrame) -> DataFrame:
    """(tree, n, chunk, slot, run, doc_id, leaf, tampered): where each leaf stands, ``run`` times in a row."""
    found = ranked(leaves, directory)
    single = found.where("not crowded").withColumn("run", F.lit(1).cast("long"))
    parts = [single.select("tree", "n", "place", "run", "doc_id", "leaf", "tampered")]
    again = F.exists("words", lambda w: w["rows"] != F.bit_count(w["bits"]))
    if directory.where(again).head(1):
        folded = found.where("crowded").groupBy("tree", "n", "place", "doc_id", "leaf", "tampered").agg(F.count("*").alias("run"))
        started = written(running_start(folded, ["tree", "place", "doc_id", "leaf"], "run", "folded"), "repeated")
        words = started.groupBy("tree", "place").agg(F.min("start").alias("word_start"))
        started = started.join(words, ["tree", "place"]).withColumn("place", F.col("place") + F.col("start") - F.col("word_start"))
        parts.append(started.select("tree", "n", "place", "run", "doc_id", "leaf", "tampered"))
    rest = []
    for df in parts:
        last = F.col("place") + F.col("run") - 1
        rest.append(
            df.withColumn("stop", last)
            .withColumn("chunk", F.explode(F.sequence(F.expr(f"place div {CHUNK}"), F.expr(f"stop div {CHUNK}"))))
            .withColumn("from", F.greatest("place", F.col("chunk") * CHUNK))
            .select(
                "tree", "n", "chunk", (F.col("from") - F.col("chunk") * CHUNK).cast("int").alias("slot"),
                (F.least("stop", F.col("chunk") * CHUNK + (CHUNK - 1)) - F.col("from") + 1).cast("int").alias("run"),
                "doc_id", "leaf", "tampered",
            )
            if df is not parts[0]
            else df.select(
                "tree", "n", F.expr(f"place div {CHUNK}").alias("chunk"), F.expr(f"int(place % {CHUNK})").alias("slot"),
                F.lit(1).alias("run"), "doc_id", "leaf", "tampered",
            )
        )
    return rest[0].unionByName(rest[1]) if rest[1:] else rest[0]


def chunked(nodes: DataFrame, name: str, *payload: str) -> DataFrame:
    """A row per chunk with its slots: (tree, n, chunk, slots), written."""
    entry = F.struct("slot", "run", *payload)
    return written(nodes.groupBy("tree", "n", "chunk").agg(F.collect_list(entry).alias("slots")), name)


# Inside a chunk


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def levels_of(nodes: list[str], n: int) -> list[list[str]]:
    """A chunk's nodes and the levels above them: to the root of a tree of one chunk, else ``LEVELS``."""
    levels = [nodes]
    while len(levels[-1]) > 1 if n <= CHUNK else len(levels) <= LEVELS:
        below = levels[-1]
        levels.append([digest("".join(below[i : i + FAN])) for i in range(0, len(below), FAN)])
    return levels


def slot_array(entries: pa.StructArray, column: str, n: int, chunk: int) -> list:
    """The values of a chunk by place."""
    size = min(CHUNK, n - chunk * CHUNK)
    values: list = [None] * size
    filled = 0
    for slot, run, value in zip(*(entries.field(c).to_pylist() for c in ("slot", "run", column))):
        values[slot : slot + run] = [value] * run
        filled += run
    if filled != size or len(values) != size:
        raise ValueError(f"chunk {chunk} has {filled} leaves in {size} slots")
    return values


def siblings(levels: list[list[str]]) -> list[list[tuple[str, str]]]:
    """What stands left and right of every node in its run, for all levels that have one above."""
    return [
        [("".join(level[i - i % FAN : i]), "".join(level[i + 1 : i - i % FAN + FAN])) for i in range(len(level))]
        for level in levels[:-1]
    ]


def path_up(beside: list[list[tuple[str, str]]], at: int, first: int = 0) -> list[tuple[str, str]]:
    return [level[at // FAN**k] for k, level in enumerate(beside) if k >= first]


def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks to their nodes, which are slots of the next chunks."""
    for batch in batches:
        out = []
        for k, (tree, n, chunk) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("tree", "n", "chunk")))):
            nodes = slot_array(batch.column("slots")[k].values, "leaf", n, chunk)
            out.append({
                "tree": tree, "n": -(-n // CHUNK), "chunk": chunk // CHUNK, "slot": chunk % CHUNK, "run": 1, "leaf": levels_of(nodes, n)[-1][0],
            })
        yield pa.RecordBatch.from_pylist(out, schema=NODES)


NODES = pa.schema([("tree", pa.string()), ("n", pa.int64()), ("chunk", pa.int64()), ("slot", pa.int32()), ("run", pa.int32()), ("leaf", pa.string())])
NODES_DDL = "tree string, n long, chunk long, slot int, run int, leaf string"
PATHS = pa.schema([
    ("tree", pa.string()), ("chunk", pa.int64()), ("lefts", pa.list_(pa.string())), ("rights", pa.list_(pa.string())),
    ("subroot", pa.string()), ("root", pa.string()),
])
PATHS_DDL = "tree string, chunk long, lefts array<string>, rights array<string>, subroot string, root string"
ROWS = pa.schema([
    ("doc_id", pa.int64()), *((c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")), ("verified", pa.bool_()),
])
ROWS_DDL = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
ABOVE = ("lefts", "rights", "subroot", "root")


def _down(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Every chunk of a batch: its row, slots, levels, siblings, and the path above it."""
    rows = zip(*(batch.column(c).to_pylist() for c in ("tree", "n", "chunk", *ABOVE)))
    for k, (tree, n, chunk, lefts, rights, subroot, root) in enumerate(rows):
        entries = batch.column("slots")[k].values
        levels = levels_of(slot_array(entries, "leaf", n, chunk), n)
        yield tree, n, chunk, entries, siblings(levels), list(zip(lefts, rights)), subroot, root


def group_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From chunks of groups' roots: the path above each group's root."""
    for batch in batches:
        for _, n, chunk, entries, beside, above, _, root in _down(batch):
            out = []
            for at, (name, subroot) in enumerate(zip(slot_array(entries, "name", n, chunk), slot_array(entries, "leaf", n, chunk))):
                path = path_up(beside, at) + above
                out.append({"tree": name, "chunk": 0, "lefts": [p[0] for p in path], "rights": [p[1] for p in path], "subroot": subroot, "root": root})
            yield pa.RecordBatch.from_pylist(out, schema=PATHS)


def chunk_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From chunks of nodes: the path above each node, which is a chunk below."""
    for batch in batches:
        for tree, n, chunk, entries, beside, above, subroot, root in _down(batch):
            out = []
            for at in entries.field("slot").to_pylist():
                path = path_up(beside, at) + above
                out.append({
                    "tree": tree, "chunk": chunk * CHUNK + at, "lefts": [p[0] for p in path], "rights": [p[1] for p in path],
                    "subroot": subroot, "root": root,
                })
            yield pa.RecordBatch.from_pylist(out, schema=PATHS)


def proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From chunks of leaves: every row with its proof, folded back to a root."""
    for batch in batches:
        for _, n, chunk, entries, beside, above, subroot, root in _down(batch):
            ids, leaves, altered = (slot_array(entries, c, n, chunk) for c in ("doc_id", "leaf", "tampered"))
            proof, folded = [], []
            upper, upper_text = above, "".join([x + y for x, y in above])
            for at, leaf in enumerate(leaves):
                if at % FAN == 0:
                    upper = path_up(beside, at, 1) + above
                    upper_text = "".join([x + y for x, y in upper])
                node, own = altered[at] or leaf, ""
                if beside:
                    left, right = beside[0][at]
                    node, own = digest(left + node + right), left + right
                for left, right in upper:
                    node = digest(left + node + right)
                proof.append(digest(own + upper_text))
                folded.append(node)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array(leaves), pa.array([subroot] * len(ids)), pa.array([root] * len(ids)),
                    pa.array(proof), pa.array(folded), pa.array([f == root for f in folded]),
                ],
                schema=ROWS,
            )


# Trees of chunks


def grow(leaf_chunks: DataFrame, most: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The chunk tables of all levels of trees of at most ``most`` leaves, and (tree, leaf) of their roots."""
    tables, roots = [leaf_chunks], []
    while True:
        nodes = written(tables[-1].mapInArrow(up, NODES_DDL), f"{name}_nodes")
        roots.append(nodes.where("n = 1").select("tree", "leaf"))
        most = -(-most // CHUNK)
        if most <= 1:
            found = roots[0]
            for more in roots[1:]:
                found = found.unionByName(more)
            return tables, found
        tables.append(chunked(nodes.where("n > 1"), f"{name}_chunks", "leaf"))


def descend(tables: list[DataFrame], tops: DataFrame, last) -> DataFrame:
    """Paths from ``tops``, above the roots, down to the lowest chunks, where ``last`` makes rows of them."""
    above = None
    for level in range(len(tables) - 1, -1, -1):
        chunks = tables[level]
        # Trees of one chunk on this level begin here, the others come from the level above.
        begin = chunks.where(F.col("n") <= CHUNK).select("tree").join(tops, "tree").select(tops.columns)
        above = begin if above is None else begin.unionByName(above)
        met = chunks.join(above, ["tree", "chunk"])
        if level:
            above = written(met.mapInArrow(chunk_paths, PATHS_DDL), "paths")
    return met.mapInArrow(*last)


def merkle_manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "source",
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    text_col: str = "text",
    tamper_every: int = 5,
) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    Rows whose id's crc32 ``tamper_every`` divides are folded from a leaf with a lower-cased text.
    """
    workers_import(docs.sparkSession)
    leaves = written(leaves_of(docs, id_col, group_col, list(columns), text_col, tamper_every), "leaves")
    directory = placed(bitmaps(leaves))
    chunks = chunked(slots(leaves, directory), "chunks", "doc_id", "leaf", "tampered")
    most = chunks.agg(F.max("n")).first()[0]
    if most is None:
        return docs.sparkSession.createDataFrame([], ROWS_DDL)
    tables, roots = grow(chunks, most, "leaf")

    # The groups' roots are the leaves of one more tree.
    one = F.lit(1).cast("long")
    ordered = running_start(roots.withColumn("one", one), ["tree"], "one", "groups")
    count = roots.count()
    tops = ordered.select(
        F.lit("").alias("tree"), F.lit(count).cast("long").alias("n"), F.expr(f"start div {CHUNK}").alias("chunk"),
        F.expr(f"int(start % {CHUNK})").alias("slot"), F.lit(1).alias("run"), "leaf", F.col("tree").alias("name"),
    )
    top_tables, root = grow(chunked(tops, "top_chunks", "leaf", "name"), count, "top")
    nothing = F.array().cast("array<string>")
    above_all = root.select(
        "tree", F.lit(0).cast("long").alias("chunk"), nothing.alias("lefts"), nothing.alias("rights"),
        F.lit(None).cast("string").alias("subroot"), F.col("leaf").alias("root"),
    )
    paths = written(descend(top_tables, above_all, (group_paths, PATHS_DDL)), "group_paths")
    return descend(tables, paths, (proofs, ROWS_DDL))


# The same as DuckDB SQL. crc32 has no function there: each byte of the id's digits is folded in eight steps.
def _field(expression: str) -> str:
    return f"coalesce(strlen(CAST({expression} AS VARCHAR)) || ':' || CAST({expression} AS VARCHAR), '-')"


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PLAIN = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
_ALTERED = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", f"translate(text, '{_UPPER}', '{_UPPER.lower()}')"))
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295::BIGINT)"""

ORACLE = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, source, sha256({_PLAIN}) AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {_CRC} % 5 = 0 THEN sha256({_ALTERED}) END AS tampered FROM documents
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
    row_number() OVER () AS row_id, count(*) OVER (PARTITION BY source) AS n FROM hashed
), nodes AS (
  SELECT source, 0 AS level, place, n, leaf AS node FROM leaves
  UNION ALL
  SELECT source, level + 1, place // 16, (n + 15) // 16, sha256(string_agg(node, '' ORDER BY place))
  FROM nodes WHERE n > 1 GROUP BY source, level, place // 16, n
), subroots AS (
  SELECT source, level AS height, node AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n
  FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS level, place, n, subroot AS node FROM subroots
  UNION ALL
  SELECT level + 1, place // 16, (n + 15) // 16, sha256(string_agg(node, '' ORDER BY place))
  FROM tops WHERE n > 1 GROUP BY level, place // 16, n
), beside AS (
  SELECT l.row_id, x.level, x.place, x.place < l.place // CAST(power(16, x.level) AS BIGINT) AS is_left, x.node
  FROM leaves l JOIN nodes x ON x.source IS NOT DISTINCT FROM l.source AND x.n > 1
    AND x.place // 16 = l.place // CAST(power(16, x.level + 1) AS BIGINT) AND x.place <> l.place // CAST(power(16, x.level) AS BIGINT)
  UNION ALL
  SELECT l.row_id, s.height + x.level, x.place, x.place < s.place // CAST(power(16, x.level) AS BIGINT), x.node
  FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source JOIN tops x ON x.n > 1
    AND x.place // 16 = s.place // CAST(power(16, x.level + 1) AS BIGINT) AND x.place <> s.place // CAST(power(16, x.level) AS BIGINT)
), sides AS (
  SELECT row_id, level, coalesce(string_agg(node, '' ORDER BY place) FILTER (WHERE is_left), '') AS lefts,
    coalesce(string_agg(node, '' ORDER BY place) FILTER (WHERE NOT is_left), '') AS rights FROM beside GROUP BY row_id, level
), heights AS (
  SELECT l.row_id, s.height + (SELECT max(level) FROM tops) AS height, s.subroot
  FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
), folded AS (
  SELECT row_id, 0 AS level, coalesce(tampered, leaf) AS node FROM leaves
  UNION ALL
  SELECT f.row_id, f.level + 1, sha256(coalesce(s.lefts, '') || f.node || coalesce(s.rights, ''))
  FROM folded f JOIN heights h ON h.row_id = f.row_id AND f.level < h.height
  LEFT JOIN sides s ON s.row_id = f.row_id AND s.level = f.level
), proofs AS (
  SELECT row_id, sha256(string_agg(lefts || rights, '' ORDER BY level)) AS proof FROM sides GROUP BY row_id
)
SELECT l.doc_id, l.leaf, h.subroot, t.node AS root, coalesce(p.proof, sha256('')) AS proof_sha256,
  f.node AS folded_root, f.node = t.node AS verified
FROM leaves l JOIN heights h ON h.row_id = l.row_id JOIN tops t ON t.n = 1
JOIN folded f ON f.row_id = l.row_id AND f.level = h.height LEFT JOIN proofs p ON p.row_id = l.row_id
"""
