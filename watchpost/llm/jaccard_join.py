"""N-gram Jaccard join: size-aware, heavy and light sets, exact.

Documents link when the Jaccard similarity of their sets of word shingles reaches a threshold;
the result is one row per document with its connected component.

Equal sets are one *class* from the start.  For the others, a fixed order of all shingles, rare
ones first, turns the join into one with a constant overlap: if two sets are similar, the first
``n - ceil(threshold * n) + overlap`` shingles of both share at least ``overlap`` (3) of them.

* **Light** sets (few shingles) enumerate the ``overlap``-subsets of that prefix; similar light
  sets have a subset in common.
* **Heavy** sets scan the inverted lists of their prefix's shingles; so do the light sets large
  enough to be similar to a heavy one, as partners only.
* The boundary between them is the size at which enumerating costs as many rows as the lists
  that are read instead, computed from the sizes and lists of all sets.

A subset or list with more than one set gets a hub, its smallest member, and each set is sent
once to each of its hubs, not once per list: copies that share fifty shingles meet once.  Pairs
are never emitted: a hub's members are compared inside tasks in blocks of fixed size, by
counting along inverted lists, and only a spanning forest of the found links leaves the task.
First only the shared parts of prefixes are sent.  What they leave possible makes groups, in which
each whole set is sent once, or once for each block of a large group.

What is broadcast has a fixed size: a table of shingle frequencies that decides only the order
(``FREQUENCY_BITS``), and a Bloom filter of the documents whose sets are needed again
(``FILTER_BITS``).  Shingles are 64-bit hashes.

Edge cases: a null text, or one without words, has no shingles and is its own component; with
fewer words than a shingle, the whole sequence is one.  Rows of equal text, also repeated rows,
are in one component.  A null ``doc_id`` links like any other but is never a component's
name; a component without any ``doc_id`` is null.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchpost.llm.batches import list_array, run_bounds, runs
from watchpost.llm.graph import components
from watchpost.llm.storage import written
from watchpost.llm.words import NOT_SPACE, chunks, mix, rolling_hashes, split_words, word_hashes

WIDTH = 4
PERCENT = 85
OVERLAP = 3
LARGEST_LIGHT = 64  # sizes up to which enumerating is considered at all
BLOCK = 512
FREQUENCY_BITS = 20  # the table has 2**20 cells of a byte
FREQUENT = 3  # copies within one buffer from which a shingle's count is reported
BUFFER = 4 << 20  # shingles
FILTER_BITS = 26  # 8 MB


def jaccard_components(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
) -> DataFrame:
    """``(id_col, n_shingles, component_id)`` for every row of ``docs``.

    Two rows link when ``100 * |A and B| >= percent * |A or B|`` for their sets of distinct
    shingles of ``width`` words (ASCII letters lower-cased, words split at white space).
    """
    rows = _row_components(docs, id_col, text_col, width, percent)
    return rows.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def _row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(id_col, text_col)


def _row_components(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """``(doc_id, row_key, n, component, component_id)`` for every row of ``docs``.

    ``component`` is the component's smallest node, and a row's own key where it has no shingles.
    """
    key = _row_key(id_col, text_col).alias("row_key")
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), key)
    levels = _frequency_levels(docs, width)
    sets = written(_sets(docs, width, percent, levels), "jaccard-sets")
    classes = written(_classes(sets), "jaccard-classes")

    members = classes.where(F.size("prefix") > 0).select("node", "n", "prefix")
    boundary = light_boundary(members, percent)
    hubs = written(_hubs(members, percent, boundary), "jaccard-hubs")
    groups = components(_possible(hubs, percent)).withColumnRenamed("component", "hub")
    placed = groups.join(classes.select("node", "n", "row_key"), "node")
    placed = written(placed, "jaccard-possible")
    links = _links(_blocks(placed), _candidate_sets(docs, placed.select("row_key"), width), percent)

    names = components(links).join(classes.select("node", "doc_id"), "node")
    least = names.groupBy("component").agg(F.min("doc_id").alias("least"))
    named = names.join(least, "component").select("node", "component", "least")
    of_class = classes.join(named, "node", "left").select(
        "set_key",
        F.coalesce("component", "node").alias("component"),
        F.coalesce("least", "doc_id").alias("component_id"),
    )
    columns = ["doc_id", "row_key", "n", "component", "component_id"]
    empty = sets.where("n = 0").withColumns({"component": F.col("row_key"), "component_id": F.col("doc_id")})
    return sets.where("n > 0").join(of_class, "set_key").select(*columns).unionByName(empty.select(*columns))


def without_near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    keep_unnamed: bool = True,
) -> DataFrame:
    """The rows of ``docs`` that are the first of their component, with their columns.

    First is the row with the smallest id, of several the one with the smallest hash of id and text.
    Rows are told apart by both, so of rows that repeat both one stays, and rows that share an id
    are judged each by its own text.  Rows without an id all stay; without ``keep_unnamed`` they
    are compared too, come last in their component, and only those without words all stay.
    """
    rows = _row_components(docs, id_col, text_col, width, percent)
    if keep_unnamed:
        rows = rows.where("doc_id is not null")
    counted = rows.groupBy("component", (F.col("n") == 0).alias("empty"), "doc_id", "row_key")
    counted = counted.agg(F.count("*").alias("rows"))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key", "rows")
    first = counted.groupBy("component", "empty").agg(F.min(order).alias("first"))
    kept = first.select(
        F.col("first.row_key").alias("__key"),
        F.col("first.doc_id").alias("__id"),
        ((F.col("first.rows") > 1) & ~(F.col("empty") & F.col("first.unnamed"))).alias("__repeated"),
    )
    kept = written(kept, "jaccard-kept")
    judged = docs.where(F.col(id_col).isNotNull()) if keep_unnamed else docs
    same = (_row_key(id_col, text_col) == F.col("__key")) & F.col(id_col).eqNullSafe(F.col("__id"))
    found = judged.join(kept.hint("merge"), same)  # as many as documents stay
    once = found.where("not __repeated").select(*docs.columns)
    # Grouped by what isn't the join's key, so that copies are merged before they are sent.
    repeated = found.where("__repeated").withColumn("__key", F.bitwise_not("__key"))
    stay = once.unionByName(repeated.dropDuplicates(["__key", "__id"]).select(*docs.columns))
    return stay.unionByName(docs.where(F.col(id_col).isNull())) if keep_unnamed else stay


# --- sets -----------------------------------------------------------------------------


def _shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Number of each text and its distinct shingles in ascending order."""
    for begin, data, offsets in chunks(column):
        words = split_words(data, offsets, NOT_SPACE, lower=True)
        hashes = word_hashes(words)
        shingles = rolling_hashes(hashes, width)
        for i, (a, z) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
            if z - a >= width:
                yield begin + i, np.unique(shingles[a : z - width + 1])
            else:
                yield begin + i, rolling_hashes(hashes[a:z], z - a) if z > a else hashes[:0]


def _needed(n, percent: int):
    """Fewest shingles that a set of ``n`` shares with a similar one."""
    return -(-percent * n // 100)


def prefix_length(n: int, percent: int) -> int:
    """Shingles among which two similar sets share ``OVERLAP``, if both have that many to share."""
    return min(n, n - _needed(n, percent) + OVERLAP)


def prefix_overlap(n, m, percent: int):
    """Fewest shingles that the prefixes of two similar sets of these sizes share.

    Of the prefix that ends earlier in the order, all shared shingles are in the other prefix too;
    behind it, the set has ``needed - OVERLAP`` more, which can be shared at most.
    """
    both = -(-percent * (n + m) // (100 + percent))
    return np.maximum(OVERLAP, both - _needed(np.maximum(n, m), percent) + OVERLAP)


def _can_link(n: int, percent: int) -> bool:
    """Whether a set of ``n`` can be similar to another one: one shingle more is too much for few."""
    return 100 * n >= percent * (n + 1)


def _frequency_levels(docs: DataFrame, width: int) -> np.ndarray:
    """Binary logarithm of the frequency, by the shingle's first bits; 0 for rare ones.

    Counted within each task; what occurs less than ``FREQUENT`` times among the shingles of a
    buffer counts as rare.  Rarity decides how long lists get, not which links are found.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def frequent() -> pa.RecordBatch:
            shingles, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= FREQUENT
            return pa.record_batch(
                [pa.array(shingles[often].view(np.int64)), pa.array(counts[often])], ["shingle", "copies"]
            )

        for batch in batches:
            for _, shingles in _shingle_sets(batch.column("text"), width):
                held.append(shingles)
                size += len(shingles)
                if size > BUFFER:
                    yield frequent()
                    held.clear()
                    size = 0
        if held:
            yield frequent()

    cells = (
        docs.select("text")
        .mapInArrow(count, "shingle long, copies long")
        .groupBy("shingle")
        .agg(F.sum("copies").alias("copies"))
        .groupBy(F.shiftrightunsigned("shingle", 64 - FREQUENCY_BITS).cast("int").alias("cell"))
        .agg(F.floor(F.log2(F.max("copies"))).cast("byte").alias("level"))
        .toArrow()  # at most 2**FREQUENCY_BITS rows
    )
    levels = np.zeros(1 << FREQUENCY_BITS, np.uint8)
    levels[cells.column("cell").to_numpy()] = cells.column("level").to_numpy()
    return levels


def _sets(docs: DataFrame, width: int, percent: int, levels: np.ndarray) -> DataFrame:
    """``(doc_id, row_key, n, set_key, prefix)`` for every row; no prefix where nothing can link."""
    table = docs.sparkSession.sparkContext.broadcast(levels)
    shift = np.uint64(64 - FREQUENCY_BITS)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.zeros(batch.num_rows, np.int64)
            keys: list[bytes | None] = [None] * batch.num_rows
            prefixes: list[np.ndarray] = [np.empty(0, np.uint64)] * batch.num_rows
            for i, shingles in _shingle_sets(batch.column("text"), width):
                sizes[i] = n = len(shingles)
                if n:
                    keys[i] = md5(shingles.tobytes()).digest()
                if n and _can_link(n, percent):
                    # Rare first; equal levels by the hash itself, which is the order they have.
                    order = np.argsort(table.value[shingles >> shift], kind="stable")
                    prefixes[i] = shingles[order[: prefix_length(n, percent)]]
            flat = np.concatenate(prefixes) if prefixes else np.empty(0, np.uint64)
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    batch.column("row_key"),
                    pa.array(sizes),
                    pa.array(keys, pa.binary()),
                    list_array(flat.view(np.int64), np.array([len(p) for p in prefixes])),
                ],
                ["doc_id", "row_key", "n", "set_key", "prefix"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(sets, f"doc_id {kind}, row_key long, n long, set_key binary, prefix array<long>")


def _classes(sets: DataFrame) -> DataFrame:
    """One row per different set, with a number, its smallest id, and one of its rows."""
    keys = sets.where("n > 0").groupBy("set_key").agg(F.min("doc_id").alias("doc_id"), F.min("row_key").alias("row_key"))
    # The prefix comes from that row alone, so that copies don't move theirs.
    rows = sets.where("n > 0").select("set_key", "row_key", "n", "prefix")
    whole = keys.join(rows, ["set_key", "row_key"]).dropDuplicates(["set_key", "row_key"])
    return whole.withColumn("node", F.monotonically_increasing_id())


# --- heavy and light ----------------------------------------------------------------------


def light_boundary(members: DataFrame, percent: int) -> int:
    """Largest light size: the one with the fewest rows in all, subsets below and lists above it."""
    small = members.where(F.col("n") <= LARGEST_LIGHT)
    lists = small.select("node", "n", F.explode("prefix").alias("shingle"))
    length = F.count("*").over(Window.partitionBy("shingle"))
    read = lists.select("n", length.alias("length")).groupBy("n").agg(F.sum("length").alias("read"))
    sizes = small.groupBy("n").agg(F.count("*").alias("sets"))
    cost = {r["n"]: (r["sets"], r["read"]) for r in sizes.join(read, "n").collect()}  # a row per small size
    best, lowest = 0, sum(read for _, read in cost.values())
    for size in sorted(cost):
        total = sum(
            sets * comb(prefix_length(n, percent), OVERLAP) if n <= size else read for n, (sets, read) in cost.items()
        )
        if total < lowest:
            best, lowest = size, total
    return best


def _subset_keys(prefixes: pa.Array) -> pa.Array:
    """Hashes of the ``OVERLAP``-subsets of each prefix."""
    subsets: dict[int, np.ndarray] = {}
    found = []
    for prefix in prefixes:
        items = np.sort(prefix.values.to_numpy().view(np.uint64))
        if len(items) not in subsets:
            subsets[len(items)] = np.array(list(combinations(range(len(items)), min(OVERLAP, len(items)))), np.intp)
        picked = items[subsets[len(items)]]
        total = np.zeros(len(picked), np.uint64)
        for k in range(picked.shape[1]):
            total = mix(total * np.uint64(0xD6E8FEB86659FD93) + picked[:, k])
        found.append(total)
    flat = np.concatenate(found) if found else np.empty(0, np.uint64)
    return list_array(flat.view(np.int64), np.array([len(x) for x in found], np.int32))


def _hubs(members: DataFrame, percent: int, boundary: int) -> DataFrame:
    """``(hub, node, n, listed, subsets)``: each set once for each hub, with the keys that it shares.

    A light set is in the lists too if it can be similar to a heavy one.  Sets that share too
    few shingles with all others together have no partner and go.
    """

    def subsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column("node"), _subset_keys(batch.column("prefix"))], ["node", "keys"])

    light = members.where(F.col("n") <= boundary).select("node", "prefix")
    enumerated = light.mapInArrow(subsets, "node long, keys array<long>").select(
        "node", F.lit(0).alias("kind"), F.explode("keys").alias("key")
    )
    partners = 100 * F.col("n") >= percent * (boundary + 1)
    listed = members.where(partners).select("node", F.lit(1).alias("kind"), F.explode("prefix").alias("key"))
    same = Window.partitionBy("kind", "key")
    shared = (
        enumerated.unionByName(listed)
        .withColumns({"hub": F.min("node").over(same), "length": F.count("*").over(same)})
        .where("length > 1")
    )
    of_kind = lambda kind: F.collect_list(F.when(F.col("kind") == kind, F.col("key")))
    of_node = (  # as many keys as its prefix gives
        shared.groupBy("node")
        .agg(F.collect_set("hub").alias("hubs"), of_kind(1).alias("listed"), of_kind(0).alias("subsets"))
        .where((F.size("listed") >= OVERLAP) | (F.size("subsets") > 0))
    )
    return of_node.join(members.select("node", "n"), "node").select(
        F.explode("hubs").alias("hub"), "node", "n", "listed", "subsets"
    )


# --- comparing --------------------------------------------------------------------------


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows with the pairs of blocks ``(hub, low, high)`` in which they are compared.

    Members are dealt over as many blocks as make about ``BLOCK`` each; every pair of blocks of a
    hub is one unit of work, so no task has to hold a large group.
    """
    counts = rows.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = rows.join(counts, "hub").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return dealt.select("*", other).select(
        *rows.columns, F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    )


def _grouped(rows: DataFrame) -> DataFrame:
    keys = ["hub", "low", "high"]
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of the numbers of elements that each two sets share, along the inverted lists."""
    members = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    elements = np.concatenate(sets)
    order = np.argsort(elements, kind="stable")
    elements, members = elements[order], members[order]
    begins = np.flatnonzero(np.r_[True, elements[1:] != elements[:-1]])
    lengths = np.diff(np.r_[begins, len(elements)])
    counts = np.zeros((len(sets), len(sets)), np.float32)
    listed = np.flatnonzero(lengths > 1)
    for a in range(0, len(listed), 4096):  # lists of some thousand elements at a time
        some = listed[a : a + 4096]
        incidence = np.zeros((len(some), len(sets)), np.float32)
        row = np.repeat(np.arange(len(some)), lengths[some])
        at = np.repeat(begins[some] - np.r_[0, np.cumsum(lengths[some])[:-1]], lengths[some]) + np.arange(len(row))
        incidence[row, members[at]] = 1
        counts += incidence.T @ incidence
    np.fill_diagonal(counts, 0)
    return counts.astype(np.int64)


def _sets_of(table: pa.Table, name: str) -> list[np.ndarray]:
    column = table.column(name).combine_chunks()
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy()
    return [values[a:z] for a, z in zip(offsets[:-1], offsets[1:])]


def _possible(hubs: DataFrame, percent: int) -> DataFrame:
    """``(u, v)``: edges that connect what is possibly similar within each pair of blocks."""

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "hub", "low", "high"):
            nodes, sizes = table.column("node").to_numpy(), table.column("n").to_numpy()
            us, vs = [], []
            listed, subsets = _sets_of(table, "listed"), _sets_of(table, "subsets")
            for a, z in run_bounds(table, "hub", "low", "high"):
                n = sizes[a:z]
                fit = shared_counts(listed[a:z]) >= prefix_overlap(n[:, None], n, percent)
                fit |= shared_counts(subsets[a:z]) > 0
                fit &= 100 * np.minimum(n[:, None], n) >= percent * np.maximum(n[:, None], n)
                for u, v in _forest(fit):
                    us.append(nodes[a + u])
                    vs.append(nodes[a + v])
            yield pa.record_batch([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    return _grouped(_blocks(hubs)).mapInArrow(possible, "u long, v long")


def _candidate_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``(row_key, shingles)`` of the wanted rows, built again from their texts.

    Tasks skip other rows by a Bloom filter of fixed size; the join with what is wanted sorts out the
    few that pass by chance.
    """
    filter_ = docs.sparkSession.sparkContext.broadcast(_filter(wanted))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies of a row within this task
        for batch in batches:
            keys = batch.column("row_key").to_numpy()
            hit = _in_filter(filter_.value, keys)
            for i in np.flatnonzero(hit):
                hit[i] = keys[i] not in seen
                seen.add(keys[i])
            batch = batch.filter(pa.array(hit))
            found = [shingles for _, shingles in _shingle_sets(batch.column("text"), width)]
            flat = np.concatenate(found) if found else np.empty(0, np.uint64)
            yield pa.record_batch(
                [batch.column("row_key"), list_array(flat.view(np.int64), np.array([len(x) for x in found], np.int32))],
                ["row_key", "shingles"],
            )

    return docs.select("row_key", "text").mapInArrow(sets, "row_key long, shingles array<long>")


def _filter_places(keys: np.ndarray) -> Iterator[np.ndarray]:
    for seed in (1, 2):
        yield mix(keys.view(np.uint64) + np.uint64(seed)) >> np.uint64(64 - FILTER_BITS)


def _in_filter(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    found = np.ones(len(keys), bool)
    for at in _filter_places(keys):
        found &= (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


def _filter(wanted: DataFrame) -> np.ndarray:
    """The filter's bytes, of which Spark returns those that aren't zero."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate(list(_filter_places(batch.column("row_key").to_numpy())))
            bit = np.left_shift(np.int64(1), (at & np.uint64(7)).astype(np.int64))
            yield pa.record_batch([pa.array((at >> np.uint64(3)).astype(np.int64)), pa.array(bit)], ["byte", "bit"])

    found = (
        wanted.select("row_key")
        .mapInArrow(places, "byte long, bit long")
        .groupBy("byte")
        .agg(F.bit_or("bit").cast("short").alias("bits"))
        .toArrow()
    )
    filter_ = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    filter_[found.column("byte").to_numpy()] = found.column("bits").to_numpy()
    return filter_


def _links(possible: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``(u, v)``: links that connect what is similar within each pair of blocks."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "hub", "low", "high"):
            nodes, sizes = table.column("node").to_numpy(), table.column("n").to_numpy()
            shingles = _sets_of(table, "shingles")
            us, vs = [], []
            for a, z in run_bounds(table, "hub", "low", "high"):
                n, both = sizes[a:z], shared_counts(shingles[a:z])
                linked = 100 * both >= percent * (n[:, None] + n - both)
                for u, v in _forest(linked):
                    us.append(nodes[a + u])
                    vs.append(nodes[a + v])
            yield pa.record_batch([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    # Merged at every size: what is wanted grows with the corpus, so it isn't broadcast for a while first.
    together = possible.hint("merge").join(sets, "row_key")
    return _grouped(together).mapInArrow(links, "u long, v long").distinct()


def _forest(linked: np.ndarray) -> Iterator[tuple[int, int]]:
    """Tree edges that connect what the matrix connects."""
    new = np.ones(len(linked), bool)
    for root in range(len(linked)):
        front = [root] if new[root] else []
        new[root] = False
        while front:
            u = front.pop()
            for v in np.flatnonzero(linked[u] & new):
                new[v] = False
                front.append(v)
                yield u, v
