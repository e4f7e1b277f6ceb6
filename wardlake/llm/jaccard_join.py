"""Operator 5: n-gram Jaccard join by universe partitions and the pigeonhole principle.

A document's set holds the hashes of its distinct ``gram``-word shingles (A to Z lower-cased);
equal sets are one class from the start. Two sets of sizes a <= b link when
``100 * common >= percent * union``, so they differ in at most
H = (100 - percent)(a + b) / (100 + percent) shingles.

*Signatures.* Sizes fall into bands; a pair belongs to the band of its smaller set, so a set
takes part in its own band and those below that can hold a partner. A band cuts the universe
of shingles by hash into segments. A segment of a set that equals the partner's gives both
the same signature; with the one-deletion neighbourhood (signatures of the segment without
each one of its shingles) so does one that differs in a single shingle. A segment thus stands
for 1 difference, or 2 with its neighbourhood if it has two shingles or more, and 0 if
empty. A set sends the signatures of segments that together stand for H + 1: the
segments that differ cannot use all of that up. In bands with neighbourhoods these are its first segments; in others its
fullest, which few sets share by chance: of segments with their shingles as tokens, in any one order of all tokens, the first H + 1 of two
sets that differ in H at most have one in common. So two sets that link share a signature. A set
whose segments stand for too little sends all of them and takes part in a second, differently
cut universe as well, and so on; after ``UNIVERSES`` of them it also sends its band itself.

*Allocation.* Per band, whether segments carry neighbourhoods follows from a cost: signatures
sent, and signatures times the sets expected to share one. Both are measured by sending a sample of some
``SAMPLE_SETS`` texts either way; a band without a set in the sample goes by an assumed ``CHANCE``. Few sets or long segments need no
neighbourhood; many sets with much in common do. The sample decides what is sent, not which links are found.

*Verification.* Each group of sets with a signature in common proposes its least member (the pivot)
against the others, one row each. Pairs whose sizes, or whose bitmaps of parities, differ by too
much cannot link and go; the others are verified on the texts, and links give
components: copies of copies never meet in pairs. In groups that still hold several components every
member meets those outside the group's largest component once: members are dealt into cells of at most
``CELL`` by ``CELL``, sizes and bitmaps are compared inside the join, and of the signatures
two sets share only the least lets a pair through. So the work has two rounds whatever the groups are
like, a pair that comes out is one that has to be verified, and no pair of components stays unchecked.

A set has two 64-bit names. Where the first one is that of two sets, which at 10^11 sets happens to a few
hundred, those sets go by both.

Defined cases: NULL and empty texts have the empty set, and each is its own component; texts
below ``gram`` words have one shingle, the whole text; repeated rows are copies of each other;
a component's id is its least id, NULL only if it holds no other; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wardlake.llm.common import gram_hashes, id_and_text, mix, same_row, tidy, word_hashes, written
from wardlake.llm.components import connected_components

GRAM = 4
PERCENT = 85
BAND_RATIO = 1.5
UNIVERSES = 6
SLACK = 1.1  # segments beyond those needed, for empty ones
CHANCE = 0.03  # that a shingle of one set is in an unrelated one, where it is not measured
SAMPLE_SETS = 8_000
PARTNER_COST = 4  # of a set that shares a signature, in signatures sent: it is proposed, placed and met again
MEMBERS_PER_SALT = 2_000
CELL = 4_000  # members of a group on either side that a task compares at a time
SKETCH = 16  # least signatures of a set by which its pairs are told to come out once
PARITY_WORDS = 8  # 64-bit words of a set's parity bitmap
ROWS = 512
_ODD = 0x9E3779B97F4A7C15


def shingles(text: str, gram: int = GRAM) -> np.ndarray:
    """Sorted distinct shingle hashes; bytes.lower() lower-cases A to Z only."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, dtype=np.uint64)
    hashes = word_hashes(found)
    if len(found) < gram:
        return mix(gram_hashes(hashes, len(found)) + np.uint64(len(found)))
    return np.unique(gram_hashes(hashes, gram))


def set_ids(items: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit names of a set, as signed integers."""
    size = np.uint64(len(items))
    names = [mix(np.array([mix(items ^ np.uint64(salt)).sum(dtype=np.uint64) + size]))[0] for salt in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
    return int(np.int64(names[0].astype(np.int64))), int(np.int64(names[1].astype(np.int64)))


@dataclass(frozen=True)
class Band:
    """Pairs whose smaller set has from ``low`` to ``high`` shingles."""

    low: int
    high: int
    differ: int  # most shingles in which such a pair differs
    segments: int = 0
    neighbours: bool = False


def bands(largest: int, percent: int) -> list[Band]:
    """Bands up to a size."""
    out, low = [], 1
    while low <= largest:
        high = max(low, math.ceil(low * BAND_RATIO) - 1)
        out.append(Band(low, high, (100 - percent) * (high + 100 * high // percent) // (100 + percent)))
        low = high + 1
    return out


def plain_segments(band: Band) -> Band:
    return replace(band, segments=math.ceil((band.differ + 1) * SLACK), neighbours=False)


def neighbour_segments(band: Band) -> Band:
    return replace(band, segments=math.ceil((band.differ + 1) / 2), neighbours=True)


def allocate(band: Band, sets: int, measured: dict[bool, float] | None = None) -> Band:
    """The cheaper of plain segments and segments with one-deletion neighbourhoods.

    ``measured``: what the two cost without and with neighbourhoods, if the sample has sets of the band.
    """
    plain, with_neighbours = plain_segments(band), neighbour_segments(band)
    if measured:
        return with_neighbours if measured.get(True, 0) < measured.get(False, 0) else plain
    need = band.differ + 1

    def cost(keys: float, held: float) -> float:
        return keys * (1 + sets * CHANCE ** max(held, 0.5))

    held = band.low / with_neighbours.segments
    a = cost(need, band.low / plain.segments)
    b = cost(need / 2 * (1 + held), held - 1)
    return plain if a <= b else with_neighbours


def signatures(items: np.ndarray, allocated: list[Band], percent: int) -> np.ndarray:
    """All signatures a set sends."""
    out = [found for _, found in band_signatures(items, allocated, percent)]
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def band_signatures(items: np.ndarray, allocated: list[Band], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Signatures with the number of their band."""
    size = len(items)
    if not size:
        return
    own = (100 - percent) * (size + 100 * size // percent) // (100 + percent)
    smallest = -(-percent * size // 100)
    for number, band in enumerate(allocated):
        if band.high < smallest or band.low > size or band.differ == 0:
            continue
        need = min(band.differ, own) + 1
        for universe in range(UNIVERSES):
            salt = np.uint64(((number + 1) * UNIVERSES + universe) * _ODD & (1 << 64) - 1)
            where = (mix(items ^ salt) >> np.uint64(32)) % np.uint64(band.segments)
            order = np.argsort(where, kind="stable")
            where, value = where[order], mix(items[order] + salt)
            first = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1])))
            held = np.diff(np.append(first, size))
            sums = np.add.reduceat(value, first)
            place = mix(where[first].astype(np.uint64) + salt)
            if not band.neighbours:
                fullest = np.argsort(-held, kind="stable")[:need]
                yield number, mix(sums[fullest] + place[fullest])
                if len(first) >= need:
                    break
                continue
            reach = np.cumsum(np.minimum(held, 2))
            enough = reach[-1] >= need
            take = int(np.searchsorted(reach, need)) + 1 if enough else len(first)
            yield number, mix(sums[:take] + place[:take])
            end = int(first[take]) if take < len(first) else size
            of = np.repeat(np.arange(take), held[:take])
            several = held[of] > 1
            yield number, mix(sums[of][several] - value[:end][several] + place[of][several])
            if enough:
                break
        else:
            yield number, mix(np.array([(number + 1) * _ODD & (1 << 64) - 1], dtype=np.uint64))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def parities(items: np.ndarray) -> np.ndarray:
    """A bitmap with a bit for each hash place: whether an odd number of shingles falls there.

    A shingle that only one of two sets has changes one bit, so two bitmaps differ in no more
    bits than the sets differ in shingles.
    """
    places = mix(items + np.uint64(0x2545F4914F6CDD1D)) % np.uint64(64 * PARITY_WORDS)
    odd = np.bincount(places.astype(np.int64), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def may_link(percent: int):
    """Whether sizes and bitmaps of two sets (n, p0... and m, q0...) leave a link possible."""
    n, m = F.col("n"), F.col("m")
    bits = sum((F.bit_count(F.col(f"p{i}").bitwiseXOR(F.col(f"q{i}"))) for i in range(PARITY_WORDS)), F.lit(0))
    close = percent * F.greatest(n, m) <= 100 * F.least(n, m)
    return close & ((100 + percent) * bits <= (100 - percent) * (n + m))


def set_name(items: np.ndarray, shared: frozenset[int]) -> int:
    """The name of a set: its first one, or both where other sets have the first as well."""
    first, second = set_ids(items)
    return first ^ second if first in shared else first


def set_rows(gram: int):
    """(doc_id, text, text_key) to doc_id, text_key, n_shingles, the set's names and its bitmap."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, names, bitmaps = [], [], []
            for text in batch.column(1):
                items = shingles(text.as_py(), gram)
                sizes.append(len(items))
                names.append(set_ids(items))
                bitmaps.append(parities(items))
            bitmaps = np.array(bitmaps, dtype=np.int64).reshape(-1, PARITY_WORDS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array([n[0] for n in names], pa.int64()), pa.array([n[1] for n in names], pa.int64()),
                 *[pa.array(bitmaps[:, i].copy(), pa.int64()) for i in range(PARITY_WORDS)]],
                names=["doc_id", "text_key", "n_shingles", "set_id", "check_id", *[f"p{i}" for i in range(PARITY_WORDS)]],
            )

    return name


def signature_rows(gram: int, percent: int, allocated: list[Band], shared: frozenset[int]):
    """(doc_id, text) to signature and set_id, each set of a task once."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                keys, sets, counts = [], [], []
                for text in batch.column(1).slice(at, ROWS):
                    items = shingles(text.as_py(), gram)
                    set_id = set_name(items, shared)
                    if len(items) and set_id not in seen:
                        seen.add(set_id)
                        keys.append(signatures(items, allocated, percent))
                        sets.append(set_id)
                        counts.append(len(keys[-1]))
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.repeat(np.array(sets, dtype=np.int64), counts))],
                        names=["signature", "set_id"],
                    )

    return send


def sample_rows(gram: int, percent: int, empty: list[Band]):
    """(doc_id, text) to the signatures of either kind: band, neighbours, signature and set_id."""
    plans = [(False, [plain_segments(b) for b in empty]), (True, [neighbour_segments(b) for b in empty])]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(1):
                items = shingles(text.as_py(), gram)
                set_id = set_ids(items)[0]
                for neighbours, plan in plans:
                    for band, found in band_signatures(items, plan, percent):
                        n = len(found)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n, band, dtype=np.int32)), pa.array(np.full(n, neighbours)), pa.array(found.view(np.int64)), pa.array(np.full(n, set_id, dtype=np.int64))],
                            names=["band", "neighbours", "signature", "set_id"],
                        )

    return send


def measured_costs(keyed: DataFrame, rows: int, gram: int, percent: int, empty: list[Band]) -> dict[int, dict[bool, float]]:
    """What the sets of a sample cost in each band, by kind: signatures, and the sets that share them in the whole table.

    One in so many texts is taken by hash, each once, so sets that share signatures are as many times rarer in the sample.
    """
    every = max(1, rows // SAMPLE_SETS)
    texts = keyed.where(F.pmod(F.xxhash64("text_key"), F.lit(every)) == 0).dropDuplicates(["text_key"]).select("doc_id", "text")
    sent = texts.mapInArrow(tidy(sample_rows(gram, percent, empty)), "band int, neighbours boolean, signature long, set_id long").distinct()
    shared = sent.groupBy("band", "neighbours", "signature").agg(F.count("*").alias("n"))
    found = shared.groupBy("band", "neighbours").agg(F.sum("n").alias("keys"), F.sum(F.col("n") * (F.col("n") - 1)).alias("met")).collect()
    out: dict[int, dict[bool, float]] = {}
    for r in found:  # a row for each band and kind
        out.setdefault(r["band"], {})[r["neighbours"]] = r["keys"] + PARTNER_COST * every * r["met"]
    return out


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(signature, set_id) in order to (signature, pivot, set_id): every later set of a group."""
    key = pivot = last = None
    for batch in batches:
        keys, sets = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(keys):
            continue
        new = np.concatenate(([key is None or keys[0] != key], keys[1:] != keys[:-1]))
        again = np.concatenate(([last is not None and sets[0] == last], sets[1:] == sets[:-1])) & ~new
        begin = np.maximum.accumulate(np.where(new, np.arange(len(keys)), -1))
        pivots = np.where(begin >= 0, sets[np.maximum(begin, 0)], pivot if pivot is not None else 0)
        keep = ~new & ~again
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[keep]), pa.array(pivots[keep]), pa.array(sets[keep])], names=["signature", "pivot", "set_id"]
        )
        key, last, pivot = keys[-1], sets[-1], pivots[-1]


def chosen_sets(gram: int, shared: frozenset[int]):
    """(set_id, text) rows whose text has that set; two texts of one hash may bring others."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits = [set_name(shingles(t.as_py(), gram), shared) == s for s, t in zip(batch.column(0).to_pylist(), batch.column(1))]
            yield batch.filter(pa.array(fits, pa.bool_()))

    return choose


def verifier(gram: int, percent: int):
    """(a, salt, b, text) with the pivot's own row (b NULL) first, to the pairs that link."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pivot = None, None
        for batch in batches:
            out = []
            for a, salt, b, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                items = shingles(text.as_py(), gram)
                if b is None:
                    at, pivot = (a, salt), items
                elif at == (a, salt) and linked(pivot, items, percent):
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"]
            )

    return verify


def verified(pairs: DataFrame, texts: DataFrame, gram: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link. A pivot's text is sent once per MEMBERS_PER_SALT partners."""
    salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS_PER_SALT).alias("salts"))
    members = pairs.join(salts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")))
    members = members.join(texts, members["b"] == texts["set_id"]).select("a", "salt", "b", "text")
    pivots = salts.join(texts, salts["a"] == texts["set_id"])
    pivots = pivots.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("long").alias("b"), "text")
    rows = members.unionByName(pivots).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return written(rows.mapInArrow(tidy(verifier(gram, percent)), "a long, b long"), "verified")


def across(members: DataFrame, possible: Column) -> DataFrame:
    """Pairs (a, b) of members of a group, of different components, that ``possible`` leaves: each once,
    but for those that share signatures beyond their least ones.

    Of such a pair at least one is outside the group's largest component; those members, the minor ones,
    are met by all others. Cells keep a group of any size from being one task.
    """
    sketches = members.groupBy("set_id").agg(F.slice(F.sort_array(F.collect_set("signature")), 1, SKETCH).alias("sketch"))
    members = written(members.join(sketches, "set_id"), "members")
    columns, rows = F.ceil(F.col("n_minor") / CELL), F.ceil(F.col("n_members") / CELL)
    block = F.xxhash64("set_id")

    def all_of(count: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), count - 1))

    minor = members.where("root <> main").select(
        F.col("signature").alias("s"), F.col("set_id").alias("x"), F.col("root").alias("other"), F.col("sketch").alias("sketch_x"),
        F.col("n").alias("m"), *[F.col(f"p{i}").alias(f"q{i}") for i in range(PARITY_WORDS)],
        F.pmod(block, columns).alias("c"), rows.alias("rows"),
    ).withColumn("r", all_of(F.col("rows"))).drop("rows")
    every = members.withColumn("row", F.pmod(block, rows)).withColumn("column", all_of(columns))
    on = (every["signature"] == minor["s"]) & (every["row"] == minor["r"]) & (every["column"] == minor["c"])
    shared = F.array_intersect("sketch", "sketch_x")
    once = ((F.col("root") == F.col("main")) | (F.col("set_id") < F.col("x"))) & (
        (F.size(shared) == 0) | (F.array_min(shared) == F.col("signature"))
    )
    found = every.join(minor, on & (F.col("root") != F.col("other")) & possible & once)
    return found.select(F.least("set_id", "x").alias("a"), F.greatest("set_id", "x").alias("b"))


def components_of(proposed: DataFrame, texts: DataFrame, shapes: DataFrame, gram: int, percent: int) -> DataFrame:
    """node and root of every set that links, from the proposing groups.

    ``shapes`` has each set's size and bitmap; pairs that these rule out are not verified.
    """
    kept = [c for c in shapes.columns if c != "set_id"]
    others = shapes.select("set_id", *[F.col(c).alias("m" if c == "n" else c.replace("p", "q")) for c in kept])
    possible = may_link(percent)
    pairs = proposed.select(F.col("pivot").alias("a"), F.col("set_id").alias("b")).distinct()
    pairs = pairs.join(shapes, pairs["a"] == shapes["set_id"]).drop("set_id")
    pairs = pairs.join(others, pairs["b"] == others["set_id"]).where(possible).select("a", "b")
    links = verified(written(pairs, "pairs"), texts, gram, percent)
    roots = connected_components(links)
    # The pivots had their turn; what is left of each group is placed in its components.
    placed = proposed.join(roots, proposed["set_id"] == roots["node"], "left")
    placed = placed.select("signature", "set_id", F.coalesce("root", "set_id").alias("root"))
    # A component that a group holds often counts once here.
    per_root = placed.groupBy("signature", "root").agg(F.count("*").alias("held"))
    open_ = per_root.groupBy("signature").agg(
        F.count("*").alias("roots"), F.sum("held").alias("n_members"), F.max(F.struct("held", "root")).alias("largest")
    ).where("roots > 1")
    open_ = open_.select(
        "signature", "n_members", F.col("largest.root").alias("main"), (F.col("n_members") - F.col("largest.held")).alias("n_minor")
    )
    open_ = written(open_, "open")
    if not open_.head(1):
        return roots
    members = written(placed.join(open_, "signature").join(shapes, "set_id"), "left")
    more = verified(written(across(members, possible).distinct(), "pairs"), texts, gram, percent)
    return connected_components(links.unionByName(more)) if more.head(1) else roots


def shared_names(sets: DataFrame) -> frozenset[int]:
    """First names that several sets have: n sets make n^2 / 2^65 of them by chance."""
    named = sets.where("n_shingles > 0").groupBy("set_id").agg((F.min("check_id") != F.max("check_id")).alias("several"))
    return frozenset(r["set_id"] for r in named.where("several").select("set_id").collect())


def jaccard_components(
    docs: DataFrame, gram: int = GRAM, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id (least id with the same set) and text_key (a
    hash that tells rows of one id apart) of every row."""
    return component_rows(docs, gram, percent, id_col, text_col).drop("stays")


def component_rows(
    docs: DataFrame, gram: int = GRAM, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The same, and whether the row stays when one row of each component does: its first by id
    (NULL last) and text_key; rows that repeat id and text stay or go together."""
    rows = id_and_text(docs, id_col, text_col)
    keyed = rows.withColumn("text_key", F.xxhash64("text"))
    parity = [f"p{i}" for i in range(PARITY_WORDS)]
    schema = "doc_id long, text_key long, n_shingles long, set_id long, check_id long, " + ", ".join(f"{p} long" for p in parity)
    sets = keyed.mapInArrow(tidy(set_rows(gram)), schema)
    sets = written(sets, "sets")
    shared = shared_names(sets)
    if shared:
        both = F.col("set_id").bitwiseXOR(F.col("check_id"))
        sets = written(sets.withColumn("set_id", F.when(F.col("set_id").isin(*shared), both).otherwise(F.col("set_id"))), "sets")
        if shared_names(sets):
            raise RuntimeError("two sets share both 64-bit names")
    # The first row of a set: the one with its least id and, of those, the least hash of its text.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "text_key")).alias("first")
    classes = sets.where("n_shingles > 0").groupBy("set_id").agg(first, F.max("n_shingles").alias("n"), *[F.min(p).alias(p) for p in parity])
    classes = written(classes.withColumn("class_id", F.col("first.doc_id")), "classes")
    largest = classes.agg(F.max("n")).head()[0] or 0
    empty = bands(largest, percent)
    edges = F.lit(np.array([b.low for b in empty] or [1]))
    sizes = classes.select(F.size(F.filter(edges, lambda e: e <= F.col("n"))).alias("band")).groupBy("band").count().collect()
    counts = {r["band"] - 1: r["count"] for r in sizes}  # a row for each band
    costs = measured_costs(keyed, sets.count(), gram, percent, empty) if counts else {}
    allocated = [allocate(b, counts.get(i, 0) + counts.get(i + 1, 0), costs.get(i)) for i, b in enumerate(empty)]
    sent = rows.mapInArrow(tidy(signature_rows(gram, percent, allocated, shared)), "signature long, set_id long")
    ordered = sent.repartition("signature").sortWithinPartitions("signature", "set_id")
    proposed = written(ordered.mapInArrow(tidy(groups), "signature long, pivot long, set_id long"), "proposed")
    needed = proposed.select("set_id").unionByName(proposed.select(F.col("pivot").alias("set_id"))).distinct()
    needed = needed.join(classes.select("set_id", "first.doc_id", "first.text_key"), "set_id")
    texts = same_row(keyed, needed, "inner").select("set_id", "text")
    texts = written(texts.mapInArrow(tidy(chosen_sets(gram, shared)), "set_id long, text string").dropDuplicates(["set_id"]), "texts")
    shapes = classes.select("set_id", "n", *parity)
    roots = components_of(proposed, texts, shapes, gram, percent)
    placed = classes.join(roots, classes["set_id"] == roots["node"], "left")
    placed = placed.select("set_id", "class_id", "first", F.coalesce("root", "set_id").alias("root"))
    least = placed.groupBy("root").agg(F.min("first").alias("stay"))
    # Written first, so that the last join reads plain partitions, which Spark splits for a large class.
    known = written(placed.join(least, "root").select("set_id", "class_id", "stay"), "known")
    full = sets.where("n_shingles > 0").join(known, "set_id").withColumn("component_id", F.col("stay.doc_id"))
    stays = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_key") == F.col("stay.text_key"))
    full = full.select("doc_id", "n_shingles", "component_id", "class_id", "text_key", stays.alias("stays"))
    own = F.col("doc_id")
    bare = sets.where("n_shingles = 0").select("doc_id", "n_shingles", own.alias("component_id"), own.alias("class_id"), "text_key", F.lit(True).alias("stays"))
    return full.unionByName(bare)
