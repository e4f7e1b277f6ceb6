"""Operator 9: mixing sources to target weights by hierarchical budgets. DataFrame functions only.

Documents hang in a tree of domain, language and source. A token budget is handed down from
the root: each node's children share its budget by their weights, but none gets more than it
can give, which is its tokens times ``max_epochs``. What a child cannot give goes to its
siblings by their weights; only what all of them together cannot give was never handed to
the parent, because a node's limit is the sum of its children's, so that shortage was met by
the parent's own siblings. Each level is one pass over its nodes, sorted by limit per weight.

A leaf's budget is spent in epochs. Whole epochs take every document once; the rest is the
longest prefix of one more epoch whose tokens fit, in the order of md5(seed, epoch, id). The prefix is
kept as its last hash: a document decides by itself whether it lies inside. To find
that hash, a leaf's hash range is cut into buckets of about ``BUCKET_ROWS`` documents, so the
running sum of a leaf with a third of all rows is spread over as many tasks as it needs.

Tokens are words ``[^\\x20\\x09-\\x0D]+``. Budgets are exact integers, rounded down.

Defined cases: NULL texts count as empty, and a document without words costs nothing; a NULL language or source is the leaf
``(none)``; repeated ids have one hash and are taken together; NULL ids hash as the empty text; a node
of weight 0 gets nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardlake.llm.common import written

BUCKET_ROWS = 10_000
BROADCAST_LEAVES = 10_000
LEVELS = ("domain", "lang", "source")
NONE = "(none)"
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """Weights (per level, by name; others get ``default_weight``), budget and epochs."""

    domain_of: Mapping[str, str] = field(default_factory=dict)  # source to domain
    default_domain: str = "other"
    weights: Mapping[str, Mapping[str, int]] = field(default_factory=dict)
    default_weight: int = 1
    budget_percent: int = 60  # of all tokens
    max_epochs: int = 2
    seed: int = 17


# The mix that is registered: sources of a table are split evenly over four domains.
PRODUCTION = Mix(
    domain_of={f"src{i}": ("web", "books", "news", "forum")[i % 4] for i in range(20)},
    weights={"domain": {"web": 40, "books": 30, "news": 20, "forum": 10}, "lang": {"en": 60, "de": 15, "fr": 15, "es": 10}},
)


def _lookup(name: Column, table: Mapping[str, object], default: object) -> Column:
    out = F.lit(default)
    if table:
        out = F.coalesce(F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[name], out)
    return out


def in_tree(docs: DataFrame, mix: Mix, lang_col: str = "lang", source_col: str = "source") -> dict[str, Column]:
    """The tree's levels as expressions over the columns of ``docs``."""
    source = F.coalesce(docs[source_col].cast("string"), F.lit(NONE))
    return {
        "domain": _lookup(source, mix.domain_of, mix.default_domain),
        "lang": F.coalesce(docs[lang_col].cast("string"), F.lit(NONE)),
        "source": source,
    }


def measured(docs: DataFrame, mix: Mix, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the levels and n_tokens of every row."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    tree = in_tree(docs, mix)
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"), *[tree[c].alias(c) for c in LEVELS],
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_tokens"),
    )


def shared_out(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Adds ``budget`` to ``nodes`` (parent columns, name, weight, capacity, parent_budget)."""
    whole = "decimal(38,0)"
    weight, capacity = F.col("weight").cast(whole), F.col("capacity").cast(whole)
    order = Window.partitionBy(*parent).orderBy((F.col("capacity").cast("double") / F.col("weight")).asc(), F.col(name))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    behind = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    nodes = nodes.withColumn("given", F.coalesce(F.sum(capacity).over(before), F.lit(0)).cast(whole))
    nodes = nodes.withColumn("weight_left", F.sum(weight).over(behind).cast(whole))
    left = F.col("parent_budget").cast(whole) - F.col("given")
    # The node can give less than its share of what those before it have left over.
    short = capacity * F.col("weight_left") <= weight * left
    nodes = nodes.withColumn("short", short)
    group = Window.partitionBy(*parent)
    taken = F.coalesce(F.sum(F.when(F.col("short"), capacity)).over(group), F.lit(0)).cast(whole)
    sharing = F.sum(F.when(~F.col("short"), weight)).over(group).cast(whole)
    share = F.expr("(parent_budget - taken) * weight div sharing")
    nodes = nodes.withColumn("taken", taken).withColumn("sharing", sharing)
    budget = F.when(F.col("short"), F.col("capacity")).otherwise(share.cast("long"))
    return nodes.withColumn("budget", budget).drop("given", "weight_left", "short", "taken", "sharing")


def leaf_budgets(rows: DataFrame, mix: Mix) -> DataFrame:
    """For every leaf its rows, tokens, budget, whole epochs and what is left for one more."""
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_docs"))
    for level in LEVELS:
        leaves = leaves.withColumn(f"{level}_weight", _lookup(F.col(level), mix.weights.get(level, {}), mix.default_weight).cast("long"))
    live = leaves.where(" AND ".join(f"{level}_weight > 0" for level in LEVELS))
    live = live.withColumn("capacity", F.col("tokens") * mix.max_epochs)
    total = rows.agg((F.coalesce(F.sum("n_tokens"), F.lit(0)) * mix.budget_percent).alias("t")).select(F.expr("t div 100").alias("parent_budget"))
    budgets = None
    for depth, level in enumerate(LEVELS):
        above, path = list(LEVELS[:depth]), list(LEVELS[: depth + 1])
        nodes = live.groupBy(*path).agg(F.sum("capacity").alias("capacity"), F.first(f"{level}_weight").alias("weight"))
        nodes = nodes.crossJoin(total) if budgets is None else nodes.join(budgets, above)  # total is one row
        budgets = shared_out(nodes, above, level).select(*path, F.col("budget").alias("parent_budget"))
    out = leaves.select(*LEVELS, "tokens", "n_docs").join(budgets, list(LEVELS), "left")
    out = out.withColumn("budget", F.coalesce("parent_budget", F.lit(0)).cast("long")).drop("parent_budget")
    epochs = F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0)
    out = out.withColumn("epochs", epochs.cast("long"))
    return out.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))


def place(mix: Mix, epochs: Column) -> Column:
    """A document's place in the order of the epoch behind ``epochs`` whole ones."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{mix.seed}:"), epochs.cast("string"), F.lit(":"), doc_id))


def prefixes(rows: DataFrame, leaves: DataFrame, mix: Mix) -> DataFrame:
    """The last hash of each leaf's prefix."""
    # Leading hash digits that cut a leaf into buckets of about BUCKET_ROWS rows.
    digits = F.greatest(F.lit(0), F.ceil(F.log(16.0, F.col("n_docs") / BUCKET_ROWS))).cast("int")
    spent = leaves.where("rest > 0").select(*LEVELS, "epochs", "rest", digits.alias("digits"))
    at = rows.join(sized(spent), list(LEVELS)).withColumn("place", place(mix, F.col("epochs")))
    at = at.withColumn("bucket", F.substring(F.col("place"), F.lit(1), F.col("digits")))
    sums = at.groupBy(*LEVELS, "bucket").agg(F.sum("n_tokens").alias("bucket_tokens"), F.first("rest").alias("rest"))
    earlier = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("bucket_tokens").over(earlier), F.lit(0)))
    # Only the bucket in which the budget ends, and the one before it, can hold the last hash.
    near = sums.where(F.col("before") <= F.col("rest")).select(*LEVELS, "bucket", "before")
    inside = Window.partitionBy(*LEVELS, "bucket").orderBy("place")  # equal places are summed together
    running = at.select(*LEVELS, "bucket", "place", "n_tokens", "rest").join(near, [*LEVELS, "bucket"])
    running = running.withColumn("sum", F.col("before") + F.sum("n_tokens").over(inside))
    return running.where("sum <= rest").groupBy(*LEVELS).agg(F.max("place").alias("last"))


def sized(leaves: DataFrame) -> DataFrame:
    """Leaves to be joined: broadcast while they are few, by a count, else as the optimizer likes."""
    few = len(leaves.head(BROADCAST_LEAVES + 1)) <= BROADCAST_LEAVES
    return F.broadcast(leaves) if few else leaves


def plan(docs: DataFrame, mix: Mix, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The measured rows and the leaves with budget, epochs and last hash, both written."""
    rows = written(measured(docs, mix, id_col, text_col), "measured")
    leaves = written(leaf_budgets(rows, mix), "leaves")
    leaves = leaves.join(prefixes(rows, leaves, mix), list(LEVELS), "left")
    return rows, written(leaves, "prefixes")


def copies(mix: Mix) -> Column:
    """How often a row joined with its leaf is taken."""
    return (F.col("epochs") + F.coalesce(place(mix, F.col("epochs")) <= F.col("last"), F.lit(False)).cast("long")).cast("long")


def mix_sources(docs: DataFrame, mix: Mix = PRODUCTION, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, domain, lang, source, n_tokens, leaf_budget and copies of every row."""
    rows, leaves = plan(docs, mix, id_col, text_col)
    joined = rows.join(sized(leaves.select(*LEVELS, "budget", "epochs", "last")), list(LEVELS))
    return joined.select("doc_id", *LEVELS, "n_tokens", F.col("budget").alias("leaf_budget"), copies(mix).alias("copies"))


def take_mix(docs: DataFrame, mix: Mix = PRODUCTION, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with all their columns, each as often as it is taken."""
    _, leaves = plan(docs, mix, id_col, text_col)
    tree = in_tree(docs, mix)
    keyed = docs.select(
        F.struct("*").alias("__row"), docs[id_col].cast("long").alias("doc_id"), *[tree[c].alias(c) for c in LEVELS]
    )
    joined = keyed.join(sized(leaves.select(*LEVELS, "epochs", "last")), list(LEVELS))
    taken = joined.withColumn("__copies", copies(mix).cast("int")).where("__copies > 0")
    return taken.select("__row", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select("__row.*")


def oracle(mix: Mix = PRODUCTION) -> str:
    """The same mix as DuckDB SQL, with one running sum per leaf."""

    def case(column: str, table: Mapping[str, object], default: object) -> str:
        quoted = [(k, f"'{v}'" if isinstance(v, str) else v) for k, v in table.items()]
        other = f"'{default}'" if isinstance(default, str) else default
        return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in quoted) + f" ELSE {other} END" if quoted else str(other)

    steps = [
        f"""s AS (SELECT doc_id, coalesce(lang, '{NONE}') AS lang, coalesce(source, '{NONE}') AS source,
          CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS n_tokens FROM documents)""",
        f"m AS (SELECT s.*, {case('source', mix.domain_of, mix.default_domain)} AS domain FROM s)",
        f"""leaf AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens,
          CAST(sum(n_tokens) AS HUGEINT) * {mix.max_epochs} AS capacity FROM m GROUP BY ALL)""",
        f"live AS (SELECT * FROM leaf WHERE "
        + " AND ".join(f"{case(level, mix.weights.get(level, {}), mix.default_weight)} > 0" for level in LEVELS) + ")",
        f"b_ AS (SELECT CAST(coalesce(sum(n_tokens), 0) AS HUGEINT) * {mix.budget_percent} // 100 AS parent_budget FROM m)",
    ]
    above = "b_"
    for depth, level in enumerate(LEVELS):
        path, parent = ", ".join(LEVELS[: depth + 1]), ", ".join(LEVELS[:depth])
        part = f"PARTITION BY {parent} " if parent else ""
        join = f"JOIN {above} USING ({parent})" if parent else f"CROSS JOIN {above}"
        steps += [
            f"""n{depth} AS (SELECT {path}, sum(capacity) AS capacity,
              CAST({case(level, mix.weights.get(level, {}), mix.default_weight)} AS HUGEINT) AS weight FROM live GROUP BY {path})""",
            f"""o{depth} AS (SELECT *, coalesce(sum(capacity) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS given,
              sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
              FROM n{depth} {join} WHERE weight > 0
              WINDOW w AS ({part}ORDER BY CAST(capacity AS DOUBLE) / CAST(weight AS DOUBLE), {level}))""",
            f"h{depth} AS (SELECT *, capacity * weight_left <= weight * (parent_budget - given) AS short FROM o{depth})",
            f"""b{depth} AS (SELECT {path}, CASE WHEN short THEN capacity ELSE
              (parent_budget - coalesce(sum(capacity) FILTER (short) OVER ({part}), 0)) * weight
              // sum(weight) FILTER (NOT short) OVER ({part}) END AS parent_budget FROM h{depth})""",
        ]
        above = f"b{depth}"
    steps += [
        f"""e AS (SELECT domain, lang, source, tokens, CAST(coalesce(parent_budget, 0) AS BIGINT) AS leaf_budget,
          CASE WHEN tokens > 0 THEN CAST(coalesce(parent_budget, 0) AS BIGINT) // tokens ELSE 0 END AS epochs
          FROM leaf LEFT JOIN {above} USING (domain, lang, source))""",
        f"""p AS (SELECT m.*, leaf_budget, epochs, leaf_budget - epochs * tokens AS rest,
          md5('{mix.seed}:' || epochs || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place FROM m JOIN e USING (domain, lang, source))""",
        "c AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place) AS running FROM p)",
    ]
    return (
        "WITH " + ", ".join(steps) + " SELECT doc_id, domain, lang, source, n_tokens, leaf_budget, "
        "CAST(epochs + CASE WHEN rest > 0 AND running <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies FROM c"
    )
