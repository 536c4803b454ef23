"""Near duplicates by MinHash with banding, exact check and star components.

A document's set holds its distinct shingles of ``k`` consecutive words (the
whole word sequence, if shorter). Documents with equal sets form one node; all
later work is on nodes.

1. ``HASHES`` universal hash functions (multiply and add on 64 bits) give the
   minima of every set; 16 bits of each are the signature.
2. ``BANDS`` bands of ``ROWS`` minima make the buckets. Two sets of similarity
   0.85 share no bucket with probability 6e-9 (``(1 - 0.85^ROWS)^BANDS``).
   Members of a bucket meet its first member, in the task that reads them and
   then once for all tasks, so a bucket with a third of all rows sends one row
   a task and is never expanded to its pairs.
3. Pairs whose signatures agree far less than linked sets do (by more than six
   standard errors) are dropped; the rest is compared on the whole sets.
4. Links are closed to components by alternating large-star and small-star.
5. A bucket whose members are still in several components may hide links that
   its first member did not show. The sets of such buckets go through inverted
   lists on their rarest shingles, counted among themselves (prefix, size and
   position rules of set similarity joins, all exact). Each list first meets
   leaders of its own, turn after turn; then its members outside its largest
   component meet the others. The lists are joined on the size classes of both
   partners too, and an entry takes part only in classes that its position can
   still reach, so texts from one template that do not link are not paired.

So apart from the probability in 2 no link is lost, and every link is checked on
whole sets.

Defined cases: null or wordless texts have the empty set, link with nothing and
are their own component; repeated rows and equal texts share a component; a
component's id is its smallest non-null id (null, if all are); a row is kept if
its id is the component's id (two nulls count as equal), so repetitions of a
kept row are kept; other columns are ignored, whatever their names; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.session import stage_table

from . import words as W
from .jaccard_join import fingerprint, shingle_sets
from .tables import prepare

T_NUM, T_DEN = 17, 20  # similarity 0.85
ROWS, BANDS = 6, 40
HASHES = ROWS * BANDS
#: Fewest equal minima of a pair that is checked: six standard errors below 0.85.
ALIKE = int(HASHES * 0.85 - 6 * (HASHES * 0.85 * 0.15) ** 0.5)

CHUNK_BYTES = 2 << 20
#: Shingles hashed at once (they stay in the processor's cache).
HASH_BLOCK = 1 << 15
#: Bucket entries a task holds before it hands them on.
FLUSH = 1 << 19
#: Turns in which lists meet leaders, at most; pairs for each list entry that
#: are compared at once.
TURNS, FEW = 3, 1
#: Rows of one key in a join of the components; nodes with more are broadcast.
HUB = 1 << 20

_GEN = np.random.default_rng(85)
_MUL = _GEN.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _GEN.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + _GEN.integers(0, 2, HASHES, dtype=np.uint64)


def least(n):
    """Least size of a partner of a set of size n."""
    return -((-T_NUM * n) // T_DEN)


# -- signatures -----------------------------------------------------------------

def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """16 bits of the ``HASHES`` minima of every (non-empty) set."""
    out = np.empty((len(sets), HASHES), dtype=np.uint64)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    upto = np.concatenate([[0], np.cumsum(sizes)])
    a = 0
    while a < len(sets):
        b = max(a + 1, int(np.searchsorted(upto, upto[a] + HASH_BLOCK, side="right")) - 1)
        block, first = np.concatenate(sets[a:b]), upto[a:b] - upto[a]
        hashed = np.empty_like(block)
        for i in range(HASHES):
            np.multiply(block, _MUL[i], out=hashed)
            np.add(hashed, _ADD[i], out=hashed)
            out[a:b, i] = np.minimum.reduceat(hashed, first)
        a = b
    return (W.mix(out) >> np.uint64(48)).astype(np.uint16)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A bucket key for every row and band of signatures."""
    parts = signature.reshape(len(signature), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), parts.shape[:2]).copy()
    for r in range(ROWS):
        keys = W.mix(keys ^ parts[:, :, r])
    return keys


def _sets_pass(k: int):
    """Rows (doc_id, key, node, n, signature) for documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in W.chunks(batches, "text", CHUNK_BYTES):
            sets = shingle_sets(W.texts_of(chunk, "text"), k)
            node = [fingerprint(s) if len(s) else None for s in sets]
            distinct = {f: s for f, s in zip(node, sets) if f is not None}
            rows = signatures(list(distinct.values()))
            signed = {f: r.tobytes() for f, r in zip(distinct, rows)}
            yield pa.RecordBatch.from_arrays(
                [*chunk.columns[:2], pa.array(node, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([signed.get(f) for f in node], pa.binary())], ["doc_id", "key", "node", "n", "signature"])
    return run


# -- buckets ----------------------------------------------------------------------

def _meet(key: np.ndarray, node: np.ndarray):
    """Pairs (key, first, other) of every bucket, and one entry a bucket."""
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    leader = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
    other = np.flatnonzero(node != node[leader])
    return (key[other], node[leader[other]], node[other]), (key[new], node[new])


_PAIR = "bucket long, a long, b long"
_NAMES = ["bucket", "a", "b"]


def _buckets_pass(parts: int):
    """Entries of all buckets. Members that meet in the task are paired there;
    one entry a bucket goes on, packed, one row for each target partition."""
    def flush(held):
        pairs, (key, node) = _meet(*(np.concatenate(x) for x in zip(*held)))
        to = (W.mix(key) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        key, node, to = key[order], node[order], to[order]
        cuts = np.searchsorted(to, np.arange(parts + 1))
        packed = [(p, key[x:y].tobytes() + node[x:y].tobytes()) for p, (x, y) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if x < y]
        m = len(pairs[0])
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in packed], pa.int32()), pa.array([x for _, x in packed], pa.binary()),
                                          *[pa.nulls(len(packed), pa.int64())] * 3], ["part", "entries", *_NAMES])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(m) % parts, pa.int32()), pa.nulls(m, pa.binary()),
                                          *[pa.array(x.view(np.int64)) for x in pairs]], ["part", "entries", *_NAMES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            node, first = np.unique(batch.column(0).to_numpy(), return_index=True)
            signed = batch.column(1).take(pa.array(first)).to_pylist()
            keys = band_keys(np.frombuffer(b"".join(signed), dtype=np.uint16).reshape(len(node), HASHES))
            held.append((keys.ravel(), np.repeat(node, BANDS)))
            size += keys.size
            if size >= FLUSH:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)
    return run


def _meet_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The buckets of one partition; pairs found earlier pass through."""
    held = []
    for batch in batches:
        entries = batch.column(1)
        for x in entries.drop_null().to_pylist():
            m = len(x) // 16
            held.append((np.frombuffer(x, np.uint64, m), np.frombuffer(x, np.int64, m, 8 * m)))
        yield pa.RecordBatch.from_arrays(batch.filter(entries.is_null()).columns[2:], _NAMES)
    if held:
        pairs, _ = _meet(*(np.concatenate(x) for x in zip(*held)))
        yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in pairs], _NAMES)


# -- checks -----------------------------------------------------------------------

#: Sizes that can link.
_SIZES = f"{T_DEN} * least(na, nb) >= {T_NUM} * greatest(na, nb)"
#: Positions of a shared element from which the overlap can still be reached; a
#: linked pair meets this at its first shared element.
_PLACES = f"least(na - pa, nb - pb) * {T_NUM + T_DEN} >= {T_NUM} * (na + nb)"


def _alike_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree in ``ALIKE`` minima at least."""
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint16).reshape(batch.num_rows, HASHES) for i in (2, 3))
        yield batch.filter(pa.array((x == y).sum(axis=1) >= ALIKE)).select([0, 1])


def _both(pairs: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """The pairs with the columns of both nodes (``<column>a``, ``<column>b``)."""
    for side in "ab":
        pairs = pairs.join(table.select(F.col("node").alias(side), *[F.col(c).alias(c + side) for c in columns]), side)
    return pairs


def check(pairs: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that link: signatures first, then whole sets."""
    sized = _both(pairs, nodes, ["n", "signature"]).filter(_SIZES)
    near = stage_table(sized.select("a", "b", "signaturea", "signatureb").mapInArrow(_alike_pass, "a long, b long"), "near")
    counted = (_both(near, sets, ["items"])
               .select("a", "b", F.size(F.array_intersect("itemsa", "itemsb")).alias("both"), (F.size("itemsa") + F.size("itemsb")).alias("sum")))
    return counted.filter(f"{T_DEN} * both >= {T_NUM} * (sum - both)").select("a", "b")


def _items_pass(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in W.chunks(batches, "text", CHUNK_BYTES):
            sets = shingle_sets(W.texts_of(chunk, "text"), k)
            yield pa.RecordBatch.from_arrays([pa.array([fingerprint(s) if len(s) else None for s in sets], pa.int64()),
                                              pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "items"])
    return run


# -- components -------------------------------------------------------------------

def _with_minimum(edges: DataFrame, minimum: DataFrame, hub: int, size: int) -> DataFrame:
    """``edges`` (x, y), ``size`` at most, with the minimum m of x. Nodes with
    more than ``hub`` edges are few (``size / hub``) and broadcast; so no task
    gets more of one key."""
    if size <= hub:
        return edges.join(minimum.select("x", "m"), "x")
    table = stage_table(minimum, "minimum")
    hubs = F.broadcast(table.filter(F.col("c") > hub).select("x", F.col("m").alias("hub_m")))
    marked = edges.join(hubs, "x", "left")
    return (marked.filter("hub_m is not null").select("x", "y", F.col("hub_m").alias("m"))
            .union(marked.filter("hub_m is null").select("x", "y").join(table.select("x", "m"), "x")))


def _large_star(edges: DataFrame, hub: int, size: int) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's minimum."""
    both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).union(edges.select(F.col("v").alias("x"), F.col("u").alias("y")))
    minimum = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"), F.count("*").alias("c"))
    return _with_minimum(both, minimum, hub, 2 * size).filter("y > x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, hub: int, size: int) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the minimum."""
    own = edges.select(F.col("u").alias("x"), F.col("v").alias("y"))
    minimum = own.groupBy("x").agg(F.min("y").alias("m"), F.count("*").alias("c"))
    found = _with_minimum(own, minimum, hub, size)
    return found.select(F.explode(F.array("x", "y")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """No node has two smaller neighbours, or a smaller and a larger one."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    seen = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not seen.filter("up > 1 or (up = 1 and down = 1)").limit(1).count()


def star_components(links: DataFrame, hub: int | None = None) -> DataFrame:
    """(node, root) for every node with a smaller one in its component; ``root``
    is the smallest. Large-star and small-star in turn until only stars are left;
    every round is written, so a lost executor costs one round."""
    edges = stage_table(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    size = edges.count()  # never grows
    limit = hub or max(HUB, size // 100_000)
    while not _are_stars(edges):
        edges = stage_table(_large_star(edges, limit, size), "large")
        edges = stage_table(_small_star(edges, limit, size), "small")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


# -- buckets over several components ------------------------------------------------

def _rooted(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _spanning_nodes(met: DataFrame, labels: DataFrame) -> DataFrame:
    """The nodes of buckets over several components."""
    members = met.select("bucket", F.explode(F.array("a", "b")).alias("node")).distinct()
    rooted = stage_table(_rooted(members, labels), "members")
    open_ = rooted.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("bucket")
    return rooted.join(open_, "bucket", "left_semi").select("node").distinct()


def _prefix_lists(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """(item, node, n, pos): the first elements of each set in a common order,
    rare ones first, as many as a linked partner must share one of. Elements of
    one set only are counted in ``pos`` but make no list."""
    items = sets.join(nodes, "node", "left_semi").select("node", F.size("items").alias("n"), F.explode("items").alias("item"))
    shared = items.groupBy("item").agg(F.count("*").alias("f")).filter("f > 1")
    own = items.join(shared, "item").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("f", "item"))).alias("own"))  # within one set
    placed = own.select("node", "n", (F.col("n") - F.size("own")).alias("alone"), F.posexplode("own").alias("i", "e"))
    first = f"n - cast(ceil({T_NUM} * n / {T_DEN}) as int) + 1"
    return placed.select(F.col("e.item").alias("item"), "node", "n", (F.col("alone") + F.col("i")).alias("pos")).filter(f"pos < {first}")


#: The class of size 50, where steps of two per cent begin.
_STEPS = 197


def size_class(n: Column) -> Column:
    """Sizes by steps of two per cent (single sizes below 50)."""
    return F.when(n < 50, n).otherwise(F.floor(F.log(n.cast("double")) / F.log(F.lit(1.02)) + 1e-9).cast("int"))


def class_low(c: Column) -> Column:
    """A size not above the sizes of a class."""
    return F.when(c < 50, c).otherwise(F.floor(F.pow(F.lit(1.02), c) - 1e-6).cast("int"))


def _reachable(n: Column, pos: Column) -> Column:
    """The classes of partners that an entry can still link with."""
    classes = F.sequence(size_class(F.ceil(n * T_NUM / T_DEN).cast("int")), size_class(F.floor(n * T_DEN / T_NUM).cast("int")))
    return F.filter(classes, lambda c: ((c < 50) | (c >= _STEPS)) & ((n - pos) * (T_NUM + T_DEN) >= T_NUM * (n + class_low(c))))


def _sides(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    names = [("node", ""), ("n", "n"), ("pos", "p"), ("root", "r")]

    def side(rows, s):
        return rows.select("item", *[F.col(c).alias(p + s) for c, p in names])
    return side(left, "a"), side(right, "b")


def _meeting(joined: DataFrame) -> DataFrame:
    return joined.filter(f"ra <> rb and {_SIZES} and {_PLACES}").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _with_leaders(entries: DataFrame, turn: int) -> DataFrame:
    """Pairs of a list's leaders (one for each size class; from the second turn
    on, one outside the largest component) with its other entries."""
    order = F.struct("pos", "node") if turn == 0 else F.struct(F.xxhash64("node", F.lit(turn)), "node")
    some = entries if turn == 0 else entries.filter("root <> main")
    leaders = (some.groupBy("item", F.floor(F.log("n") / F.log(F.lit(T_DEN / T_NUM))).alias("c"))
               .agg(F.min_by(F.struct("node", "n", "pos", "root"), order).alias("x")).select("item", "x.*"))
    a, b = _sides(leaders, entries)
    return _meeting(a.join(b, "item"))


def _all_across(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides of the join of entries outside their list's largest component
    with all others. They name the list and the classes of both partners, so an
    entry that sizes and positions let reach nobody is not joined."""
    a, b = _sides(entries.filter("root <> main"), entries)
    a = a.withColumns({"ca": size_class(F.col("na")), "cb": F.explode(_reachable(F.col("na"), F.col("pa")))})
    b = b.withColumns({"cb": size_class(F.col("nb")), "ca": F.explode(_reachable(F.col("nb"), F.col("pb")))})
    return a, b


_JOINED = ["item", "ca", "cb"]


def _rows_joined(a: DataFrame, b: DataFrame) -> int:
    """How many rows the join of two sides makes, from the counts of its keys."""
    counts = a.groupBy(*_JOINED).agg(F.count("*").alias("x")).join(b.groupBy(*_JOINED).agg(F.count("*").alias("y")), _JOINED)
    return counts.agg(F.sum(F.col("x") * F.col("y"))).first()[0] or 0


def _close_buckets(met: DataFrame, labels: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Components after every pair that a bucket can still link was compared.

    Leaders are met as long as the pairs left are more than ``FEW`` for each
    entry; then, or after ``TURNS`` turns, all that is left is compared."""
    rest = stage_table(_spanning_nodes(met, labels), "rest")
    if not rest.limit(1).count():
        return labels
    lists = stage_table(_prefix_lists(sets, rest), "lists")
    tried = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    for turn in range(TURNS + 1):
        rooted = _rooted(lists, labels)
        sizes = (rooted.groupBy("item", "root").agg(F.count("*").alias("c"))
                 .groupBy("item").agg(F.sum("c").alias("m"), F.max(F.struct("c", "root")).alias("top"))
                 .filter("m > top.c").select("item", F.col("top.root").alias("main")))
        entries = stage_table(rooted.join(sizes, "item"), "open")
        a, b = _all_across(entries)
        last = turn == TURNS or _rows_joined(a, b) <= FEW * entries.count()
        pairs = _meeting(a.join(b, _JOINED)) if last else _with_leaders(entries, turn)
        pairs = stage_table(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        found = stage_table(check(pairs, nodes, sets), "links")
        if found.limit(1).count():
            labels = star_components(found.union(labels.select("node", "root")))
        if last:
            return labels
        tried = tried.union(pairs)
    return labels


# -- operator ---------------------------------------------------------------------

def near_duplicates(docs: DataFrame, k: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    spark = docs.sparkSession
    prepare(spark)
    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(docs[id_col].alias("doc_id"), F.xxhash64(docs[id_col], docs[text_col]).alias("key"), docs[text_col].alias("text"))
    rows = stage_table(source.mapInArrow(_sets_pass(k), f"doc_id {id_type}, key long, node long, n long, signature binary"), "signatures")
    filled = rows.filter("node is not null")

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), filled.count() * BANDS // (4 * FLUSH) + 1)
    met = stage_table(filled.select("node", "signature").mapInArrow(_buckets_pass(parts), f"part int, entries binary, {_PAIR}")
                      .repartition(parts, "part").mapInArrow(_meet_pass, _PAIR), "buckets")
    pairs = stage_table(met.select("a", "b").distinct(), "pairs")
    members = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    nodes = stage_table(filled.join(members, "node", "left_semi").groupBy("node")
                        .agg(F.min("key").alias("key"), F.first("n").alias("n"), F.first("signature").alias("signature")), "nodes")
    texts = source.select("key", "text").join(nodes.select("key"), "key", "left_semi").select("text")
    items = texts.mapInArrow(_items_pass(k), "node long, items array<long>")
    sets = stage_table(items.join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"]), "sets")

    labels = _close_buckets(met, star_components(check(pairs, nodes, sets)), nodes, sets)

    low = filled.groupBy("node").agg(F.min("doc_id").alias("low"))  # min leaves nulls out
    named = _rooted(low, labels)
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    found = rows.select("doc_id", "node", "n").join(named.join(lowest, "root").select("node", "component_id"), "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
