"""Operator 4: exact deduplication by deterministic block naming. DataFrame functions only.

A normalised text (A to Z lower-cased) is cut into blocks of ``BLOCK_BYTES``; every block gets an
integer name, then every pair of adjacent names, and so on, until one name is left: the
document's identity. Names are integers of 128 bits, a salted hash of the block, or of the two names of a
pair: ranks of sorted blocks would have to be carried back to every block by a second shuffle. What
makes the names collision-free is not the hash but the check that follows: the distinct blocks are
brought together by name, as are the distinct pairs of every level, and a name with two
contents sends the whole naming to its next salt, which at 10^12 blocks has a chance of 10^-15. With a salt that
passes, equal identities of equally long texts mean equal texts, and names depend on nothing
but the texts and the salt.

Only the check moves texts, each distinct block of a task once; copies are merged before the
shuffle. Everything else is a few integers per document, and groups are counted before
they are joined, so a group with a third of all rows is one row from each task.

Defined cases: a NULL text counts as empty, and empty texts are equal; of repeated rows with one id and one text
just one stays; the greatest id of a group stays, any id being greater than
NULL; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardlake.llm.common import ascii_lower, id_and_text, written

BLOCK_BYTES = 4096
SALTS = 16


def blocks_of(data: Column, size: int) -> Column:
    """The blocks of a binary value, one empty block of an empty one."""
    count = F.greatest(F.lit(1), F.ceil(F.octet_length(data) / size).cast("int"))
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(data, i * size + 1, F.lit(size)))


def pairs_of(names: Column) -> Column:
    """Adjacent pairs of names; a last name without a partner is paired with NULL."""
    half = F.ceil(F.size(names) / 2).cast("int")
    return F.transform(
        F.sequence(F.lit(0), half - 1),
        lambda i: F.struct(F.get(names, i * 2).alias("left"), F.get(names, i * 2 + 1).alias("right")),
    )


def name_of(salt: int, level: int, data: Column) -> Column:
    """128 bits for bytes of a level: 0 for blocks, then up."""
    return F.unhex(F.md5(F.concat(F.lit(f"{salt}:{level}:").cast("binary"), data)))


def name_of_pair(level: int, salt: int):
    # Names are equally long, so whether there is a partner is part of what is named.
    return lambda p: name_of(salt, level + 1, F.concat(p["left"], F.coalesce(p["right"], F.lit(b""))))


def named(docs: DataFrame, salt: int, levels: int) -> DataFrame:
    """doc_id, n_bytes, sha256, names of the blocks, pairs of each level, and the identity."""
    rows = docs.select("doc_id", F.encode(ascii_lower(F.col("text")), "UTF-8").alias("data"))
    names = F.transform(blocks_of(F.col("data"), BLOCK_BYTES), lambda b: name_of(salt, 0, b))
    rows = rows.select(
        "doc_id", F.monotonically_increasing_id().alias("row"), F.octet_length("data").alias("n_bytes"), F.sha2("data", 256).alias("text_sha256"), names.alias("names")
    )
    return climbed(rows, salt, levels)


def climbed(rows: DataFrame, salt: int, levels: int) -> DataFrame:
    """Adds for each level its pairs, and at the end the one name that is left."""
    below = F.col("names")
    for level in range(levels):
        rows = rows.withColumn(f"pairs_{level}", F.when(F.size(below) > 1, pairs_of(below)))
        up = F.transform(F.col(f"pairs_{level}"), name_of_pair(level, salt))
        rows = rows.withColumn(f"names_{level}", F.when(F.size(below) > 1, up).otherwise(below))
        below = F.col(f"names_{level}")
    return rows.withColumn("identity", F.get(below, F.lit(0)))


def same_name(docs: DataFrame, light: DataFrame, salt: int, levels: int) -> bool:
    """Whether two different blocks, or two different pairs of a level, share a name."""
    data = F.encode(ascii_lower(F.col("text")), "UTF-8")
    block = docs.select(F.explode(blocks_of(data, BLOCK_BYTES)).alias("content"))
    block = block.select(F.lit(-1).alias("level"), name_of(salt, 0, F.col("content")).alias("name"), "content")
    clashes = block.distinct().groupBy("level", "name").count().where("count > 1").select("level")
    for level in range(levels):
        pair = light.select(F.explode(f"pairs_{level}").alias("p")).select("p.left", "p.right")
        pair = pair.withColumn("name", name_of_pair(level, salt)({"left": F.col("left"), "right": F.col("right")}))
        found = pair.distinct().groupBy("name").count().where("count > 1").select(F.lit(level).alias("level"))
        clashes = clashes.unionAll(found)
    return bool(clashes.head(1))


def identities(docs: DataFrame) -> DataFrame:
    """doc_id, row (a number that no two rows share), n_bytes, text_sha256 and identity, from a written table."""
    longest = docs.agg(F.max(F.octet_length("text"))).head()[0] or 0
    levels = max(0, -(-longest // BLOCK_BYTES) - 1).bit_length()  # lower-casing A to Z keeps lengths
    for salt in range(SALTS):
        light = written(named(docs, salt, levels), "names")
        if not same_name(docs, light, salt, levels):
            return light.select("doc_id", "row", "n_bytes", "text_sha256", "identity")
    raise RuntimeError(f"{SALTS} salts gave two texts one name")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 and n_bytes of every row."""
    rows = identities(id_and_text(docs, id_col, text_col))
    # Rows that repeat id and text are told apart by their number; one of them stays.
    groups = rows.groupBy("identity", "n_bytes").agg(F.max(F.struct("doc_id", "row")).alias("stay"), F.count("*").alias("group_size"))
    # Nothing but the join needs a group together, and both its sides are plain partitions, so
    # Spark splits those of a large group.
    joined = rows.join(written(groups, "groups"), ["identity", "n_bytes"])
    kept = F.col("row") == F.col("stay.row")
    return joined.select(
        "doc_id", F.col("stay.doc_id").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256", F.col("n_bytes").cast("long")
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    found = exact_dedup(docs, id_col, text_col)
    stay = found.where("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"))
    stay = written(stay, "stay")
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    sha = F.sha2(F.encode(ascii_lower(text), "UTF-8"), 256)
    same = docs[id_col].cast("long").eqNullSafe(stay["__id"]) & (sha == stay["__sha"])
    rows = docs.join(stay, same, "left_semi")
    # Rows of one id and normalised text all pass; only if there are any is a row picked.
    if found.where((F.col("group_size") > 1) & ~F.col("kept") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).head(1):
        keyed = rows.select(F.struct("*").alias("row"), docs[id_col].cast("long").alias("id"), sha.alias("sha"))
        rows = keyed.dropDuplicates(["id", "sha"]).select("row.*")
    return rows


ORACLE = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents
), n AS (
  SELECT *, row_number() OVER (PARTITION BY norm, doc_id ORDER BY doc_id) AS again,
    max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size
  FROM t
)
SELECT doc_id, keep_id, group_size, (doc_id IS NOT DISTINCT FROM keep_id AND again = 1) AS kept,
  sha256(norm) AS text_sha256, octet_length(encode(norm)) AS n_bytes
FROM n
"""
