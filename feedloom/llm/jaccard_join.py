"""Size-aware heavy-light similarity join on word shingles (Jaccard).

A document's set holds its distinct shingles of ``k`` consecutive words (the
whole word sequence, if shorter). Documents with equal sets form one node, told
by a 64-bit fingerprint of the set and its size; all later work is on nodes.

* Light: sets of at most ``boundary`` shingles enumerate, for every partner size
  ``m`` that can reach the threshold, all subsets of the fixed size
  ``need(n, m)``. Two sets of sizes n and m link exactly if they share one.
* Heavy: pairs with a larger set go through inverted lists. By the prefix rule
  two linked sets share an element among their first ``n - ceil(t n) + 1`` ones
  in any common order; the order puts elements found often last.
* The boundary between them minimises the summed cost over the global histogram
  of set sizes (rows written by either way, and set elements shipped to check).

Lists are never expanded to all pairs. Inside a list, every set is compared with
one leader of similar size, first in the task that reads it, then leaders among
themselves. After the found links are closed to components, only lists that
still span several components go on: they compare more leaders with their other
components, turn after turn, and at last all pairs left across components and
within the size limits; so no link between different components is lost.
Candidates are first compared by parity maps of their sets (a few bits for each
element), which can only rule out pairs that do not link, and then exactly on
their whole sets.

Components come from minimum labels with pointer jumping, each round written to
the shared folder.

Defined cases: null or wordless texts have the empty set, link with nothing and
are their own component; repeated rows and equal texts share a component; a
component's id is its smallest non-null id (null, if all are); other columns are ignored (or passed
on by ``keep_one``); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import stage_table

from . import words as W
from .tables import prepare

CHUNK_BYTES = 2 << 20
#: Prefix elements a task holds before it hands them on.
FLUSH = 1 << 19
#: Entries of the order hint sent to the tasks (12 bytes each).
ORDER_HINTS = 1 << 17
#: Bits of the filter that keeps texts without candidates from being shuffled.
FILTER_BITS = 1 << 23
MAX_LIGHT = 16
#: Entries of a long list that are compared with all others in a turn; turns.
LEADERS = 16
TURNS = 2
T_NUM, T_DEN = 4, 5  # threshold 0.8


def need(n, m):
    """Least overlap of sets of sizes n and m with Jaccard >= 0.8."""
    return -((-T_NUM * (n + m)) // (T_NUM + T_DEN))


def least(n):
    """Least size of a partner of a set of size n."""
    return -((-T_NUM * n) // T_DEN)


def most(n):
    return n * T_DEN // T_NUM


def light_rows(n: int, boundary: int) -> int:
    """Subset rows that a set of size n writes."""
    return sum(comb(n, need(n, m)) for m in range(least(n), min(most(n), boundary) + 1))


def choose_boundary(histogram: dict[int, int]) -> int:
    """Boundary with the least cost. Light: subset rows. Heavy: prefix rows,
    and the whole set once for the check; sets that can link with a larger one
    pay for both."""
    def cost(x: int) -> int:
        total = 0
        for n, docs in histogram.items():
            if n <= x:
                total += docs * light_rows(n, x)
            if most(n) > x:
                total += docs * (n - least(n) + 1 + n)
        return total
    return min(range(MAX_LIGHT + 1), key=lambda x: (cost(x), x))


# -- sets -------------------------------------------------------------------

def shingle_sets(texts: list[bytes | None], k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    w = W.split(texts, W.SPACE_WORDS)
    h = W.hash_words(w)
    grams = W.ngram_hashes(h, k)
    out = []
    for a, b in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist()):
        if b - a >= k:
            s = np.sort(grams[a:b - k + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        else:
            out.append(W.ngram_hashes(h[a:b], b - a) if b > a else np.empty(0, dtype=np.uint64))
    return out


def fingerprint(s: np.ndarray) -> int:
    """A 64-bit hash of a set, as a signed integer."""
    with np.errstate(over="ignore"):
        total = np.add.reduce(W.mix(s + np.uint64(0xA0761D6478BD642F)), dtype=np.uint64)
        mixed = W.mix(np.array([total + np.uint64(len(s)) * np.uint64(0xE7037ED1A0B428DB)], dtype=np.uint64))
    return int(mixed.view(np.int64)[0])


def parity_map(s: np.ndarray) -> bytes:
    """Two to four bits for each element of a set: bit ``element mod size`` is
    flipped by every element. The maps of two sets differ in no more bits than
    the sets differ in elements."""
    size = max(64, 1 << (2 * len(s) - 1).bit_length())
    return np.packbits((np.bincount((s & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1).astype(bool), bitorder="little").tobytes()


def maps_differ(a: bytes, b: bytes) -> int:
    """In how many bits two parity maps differ, the larger one folded."""
    x, y = (np.frombuffer(m, dtype=np.uint64) for m in sorted((a, b), key=len))
    if len(y) > len(x):
        y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def _sets_pass(k: int):
    """Rows (doc_id, key, node, n, map) for documents, and (element, count) hints for
    elements that several sets of a chunk hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in W.chunks(batches, "text", CHUNK_BYTES):
            sets = shingle_sets(W.texts_of(chunk, "text"), k)
            n = np.array([len(s) for s in sets], dtype=np.int64)
            node = [fingerprint(s) if len(s) else None for s in sets]
            distinct = list({f: s for f, s in zip(node, sets) if f is not None}.values())
            common = np.sort(np.concatenate(distinct)) if distinct else np.empty(0, dtype=np.uint64)
            if len(common):
                first = np.flatnonzero(np.concatenate([[True], common[1:] != common[:-1]]))
                times = np.diff(np.concatenate([first, [len(common)]]))
                many = times >= 3
                common, times = common[first[many]], times[many]
            else:
                times = np.empty(0, dtype=np.int64)
            rows, hints = chunk.num_rows, len(common)
            ids, key = (pa.concat_arrays([c, pa.nulls(hints, c.type)]) for c in chunk.columns[:2])
            yield pa.RecordBatch.from_arrays(
                [ids, key, pa.array(node + [None] * hints, type=pa.int64()),
                 pa.concat_arrays([pa.array(n), pa.nulls(hints, pa.int64())]),
                 pa.concat_arrays([pa.nulls(rows, pa.int64()), pa.array(common.view(np.int64))]),
                 pa.concat_arrays([pa.nulls(rows, pa.int64()), pa.array(times.astype(np.int64))]),
                 pa.array([parity_map(s) if len(s) else None for s in sets] + [None] * hints, type=pa.binary())],
                ["doc_id", "key", "node", "n", "element", "times", "map"])
    return run


# -- light sets -------------------------------------------------------------

def _subsets_pass(k: int, boundary: int):
    """Rows (small, large, key, node, n): the subsets of light sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in W.chunks(batches, "text", CHUNK_BYTES):
            small, large, key, node, size, seen = [], [], [], [], [], set()
            for s in shingle_sets(W.texts_of(chunk, "text"), k):
                n = len(s)
                if not 0 < n <= boundary or (f := fingerprint(s)) in seen:
                    continue
                seen.add(f)
                for m in range(least(n), min(most(n), boundary) + 1):
                    for subset in combinations(range(n), need(n, m)):
                        small.append(min(n, m))
                        large.append(max(n, m))
                        key.append(fingerprint(s[list(subset)]))
                        node.append(f)
                        size.append(n)
            yield pa.RecordBatch.from_pydict({"small": pa.array(small, pa.int32()), "large": pa.array(large, pa.int32()), "key": pa.array(key, pa.int64()),
                                              "node": pa.array(node, pa.int64()), "n": pa.array(size, pa.int64())})
    return run


def light_links(docs: DataFrame, k: int, boundary: int) -> DataFrame:
    """Links (a, b) that connect all light sets sharing a subset."""
    rows = docs.mapInArrow(_subsets_pass(k, boundary), "small int, large int, key long, node long, n long")
    group = rows.groupBy("small", "large", "key").agg(
        F.min("node").alias("a"), F.max("node").alias("b"),
        F.min("n").alias("low"), F.max("n").alias("high"))
    # Of different sizes, both must be there; then all of them are connected.
    hubs = group.filter("a <> b and (small = large or low <> high)").select("small", "large", "key", "a")
    return rows.select("small", "large", "key", F.col("node").alias("b")).join(hubs, ["small", "large", "key"]).filter("a <> b").select("a", "b").distinct()


# -- heavy sets: inverted lists ----------------------------------------------

class _Hints:
    """Order hint: elements found often, with their counts."""

    def __init__(self, elements: np.ndarray, times: np.ndarray):
        order = np.argsort(elements)
        self.elements, self.times = elements[order], times[order]
        self.coarse = np.zeros(1 << 20, dtype=bool)
        self.coarse[(self.elements >> np.uint64(44)).astype(np.int64)] = True

    def prefix(self, s: np.ndarray, length: int) -> np.ndarray:
        """The first ``length`` elements: rarely found ones by hash, then the others by count."""
        maybe = np.flatnonzero(self.coarse[(s >> np.uint64(44)).astype(np.int64)])
        at = W.find(self.elements, s[maybe])
        maybe, at = maybe[at >= 0], at[at >= 0]
        if not len(maybe):
            return s[:length]
        rare = np.ones(len(s), dtype=bool)
        rare[maybe] = False
        head = s[rare][:length]
        if len(head) == length:
            return head
        often = np.lexsort((self.elements[at], self.times[at]))
        return np.concatenate([head, s[maybe][often][:length - len(head)]])


def _stars(token: np.ndarray, node: np.ndarray, n: np.ndarray, pos: np.ndarray):
    """Inside every list: classes of similar size, a leader for each class.

    The leader is the set that has the element earliest in its order (of near
    copies, the one with the fewest elements of its own). Returns pairs (token,
    a, b, na, nb, pa, pb) of entries with their leader and of a list's leaders in
    a row, and the leaders' entries."""
    size_class = np.floor(np.log(n) / np.log(T_DEN / T_NUM)).astype(np.int64)
    order = np.lexsort((node, pos, size_class, token))
    token, node, n, pos, size_class = (x[order] for x in (token, node, n, pos, size_class))
    if not len(token):
        return (token, node, node, n, n, pos, pos), (token, node, n, pos)
    fresh = np.concatenate([[True], (token[1:] != token[:-1]) | (node[1:] != node[:-1])])
    token, node, n, pos, size_class = (x[fresh] for x in (token, node, n, pos, size_class))
    listed = np.concatenate([[True], token[1:] != token[:-1]])
    leads = listed | np.concatenate([[True], size_class[1:] != size_class[:-1]])
    at = np.arange(len(token))
    leader = np.maximum.accumulate(np.where(leads, at, 0))
    before = np.concatenate([[0], leader[:-1]])                   # the class before
    leader = np.where(leads & ~listed, before, leader)
    b = np.flatnonzero(leader != at)
    a = leader[b]
    return (token[b], node[a], node[b], n[a], n[b], pos[a], pos[b]), (token[leads], node[leads], n[leads], pos[leads])


_PAIR = "token long, a long, b long, na long, nb long, pa long, pb long"
_COLUMNS = ["token", "a", "b", "na", "nb", "pa", "pb"]


def _lists_pass(k: int, boundary: int, parts: int, hints):
    """Prefix elements of all sets that may link through a list. Elements that
    meet in the task are paired with their leader there; the leaders' entries go
    on, packed, one row for each target partition."""
    def pack(token, node, n, pos):
        to = (W.mix(token) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        token, node, n, pos, to = (x[order] for x in (token, node, n, pos, to))
        cuts = np.searchsorted(to, np.arange(parts + 1))
        for p in range(parts):
            a, b = cuts[p], cuts[p + 1]
            if a < b:
                yield p, b"".join([token[a:b].tobytes(), node[a:b].tobytes(), n[a:b].astype(np.int32).tobytes(), pos[a:b].astype(np.int32).tobytes()])

    def flush(held):
        pairs, kept = _stars(*(np.concatenate(x) for x in zip(*held)))
        packed = list(pack(*kept))
        m = len(pairs[0])
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in packed], pa.int32()), pa.array([x for _, x in packed], pa.binary()),
                                          *[pa.nulls(len(packed), pa.int64())] * len(_COLUMNS)], ["part", "entries", *_COLUMNS])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(m) % parts, pa.int32()), pa.nulls(m, pa.binary()),
                                          *[pa.array(x.view(np.int64)) for x in pairs]], ["part", "entries", *_COLUMNS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = hints.value
        held, size, seen = [], 0, set()
        for chunk in W.chunks(batches, "text", CHUNK_BYTES):
            for s in shingle_sets(W.texts_of(chunk, "text"), k):
                if most(len(s)) <= boundary or (f := fingerprint(s)) in seen:
                    continue
                seen.add(f)
                head = order.prefix(s, len(s) - least(len(s)) + 1)
                held.append((head, np.full(len(head), f, dtype=np.int64), np.full(len(head), len(s), dtype=np.int64), np.arange(len(head))))
                size += len(head)
            if size >= FLUSH:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)
    return run


def _meet_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lists of one partition: leaders of the tasks meet; pairs found
    earlier pass through."""
    held = []
    for batch in batches:
        entries = batch.column(1)
        for x in entries.drop_null().to_pylist():
            m = len(x) // 24
            held.append((np.frombuffer(x, np.uint64, m), np.frombuffer(x, np.int64, m, 8 * m),
                         np.frombuffer(x, np.int32, m, 16 * m).astype(np.int64), np.frombuffer(x, np.int32, m, 20 * m).astype(np.int64)))
        yield pa.RecordBatch.from_arrays(batch.filter(entries.is_null()).columns[2:], _COLUMNS)
    if held:
        pairs, _ = _stars(*(np.concatenate(x) for x in zip(*held)))
        yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in pairs], _COLUMNS)


# -- exact check --------------------------------------------------------------

#: Sizes that can link, and positions of a shared element from which the overlap
#: can still be reached. A linked pair meets this at its first shared element.
_CAN_LINK = (f"{T_DEN} * least(na, nb) >= {T_NUM} * greatest(na, nb) and "
             f"least(na - pa, nb - pb) * {T_NUM + T_DEN} >= {T_NUM} * (na + nb)")


def _sets_of(docs: DataFrame, nodes: DataFrame, doc_nodes: DataFrame, k: int) -> DataFrame:
    """(node, items) for the given nodes: whole sets, computed from the texts of
    one document each. A bit filter of fixed size keeps other texts out of the
    shuffle; it may let some through, which the exact join drops."""
    ids = doc_nodes.select("node", "key").join(nodes, "node").groupBy("node").agg(F.min("key").alias("key"))
    bits = (ids.select(F.pmod("key", F.lit(FILTER_BITS)).alias("slot"))
            .selectExpr("cast(slot div 64 as int) w", "shiftleft(1L, cast(slot % 64 as int)) bit")
            .groupBy("w").agg(F.bit_or("bit").alias("bits")).toArrow())  # FILTER_BITS / 64 rows at most
    mask = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    mask[bits["w"].to_numpy()] = bits["bits"].to_numpy()
    sent = docs.sparkSession.sparkContext.broadcast(np.unpackbits(mask.view(np.uint8), bitorder="little").astype(bool))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bit = sent.value
        for batch in batches:
            slots = batch.column(0).to_numpy(zero_copy_only=False) % FILTER_BITS
            some = batch.filter(pa.array(bit[slots]))
            for chunk in W.chunks(iter([some]), "text", CHUNK_BYTES):
                sets = shingle_sets(W.texts_of(chunk, "text"), k)
                at = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                items = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays([chunk.column(0), pa.array([fingerprint(s) if len(s) else None for s in sets], pa.int64()),
                                                  pa.ListArray.from_arrays(at, pa.array(items))], ["key", "node", "items"])

    found = docs.select("key", "text").mapInArrow(run, "key long, node long, items array<long>")
    return found.join(ids, ["node", "key"], "left_semi").dropDuplicates(["node"])


def _maps_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose parity maps leave room for a link. Linked sets of sizes n and
    m differ in ``n + m - 2 need(n, m)`` elements at most."""
    for batch in batches:
        rows = zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5)))
        yield batch.filter(pa.array([maps_differ(ma, mb) <= na + nb - 2 * need(na, nb) for na, nb, ma, mb in rows], pa.bool_())).select([0, 1])


def check(pairs: DataFrame, docs: DataFrame, doc_nodes: DataFrame, k: int) -> DataFrame:
    """The pairs (a, b) whose Jaccard similarity reaches the threshold. Parity
    maps drop most others; what is left is compared on the whole sets."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    maps = stage_table(doc_nodes.join(nodes, "node", "left_semi").groupBy("node").agg(F.first("n").alias("n"), F.first("map").alias("map")), "maps")
    near = stage_table(pairs.join(maps.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("map").alias("ma")), "a")
                       .join(maps.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("map").alias("mb")), "b")
                       .select("a", "b", "na", "nb", "ma", "mb").mapInArrow(_maps_pass, "a long, b long"), "near")
    nodes = near.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = stage_table(_sets_of(docs, nodes, doc_nodes, k).select("node", "items"), "sets")
    both = (near.join(sets.select(F.col("node").alias("a"), F.col("items").alias("sa")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("items").alias("sb")), "b")
            .select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("both"), (F.size("sa") + F.size("sb")).alias("sum")))
    return both.filter(f"{T_DEN} * both >= {T_NUM} * (sum - both)").select("a", "b")


# -- components ---------------------------------------------------------------

def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that links reach. Minimum labels and
    pointer jumping; every round is written, so lost executors cost one round."""
    edges = stage_table(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = stage_table(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "labels")
    while True:
        near = (edges.join(labels.select(F.col("node").alias("b"), F.col("root").alias("r")), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("r").alias("r")))
        lower = labels.join(near, "node").select("node", F.least("root", "r").alias("root"), F.col("root").alias("old"))
        hops = labels.select(F.col("node").alias("root"), F.col("root").alias("hop"))
        nxt = stage_table(lower.join(hops, "root", "left").select("node", F.least("root", F.coalesce("hop", "root")).alias("root"), "old"), "labels")
        labels = nxt.select("node", "root")
        if not nxt.filter("root <> old").limit(1).count():
            return labels


# -- lists over several components ----------------------------------------------

def _spanning(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The entries of lists over several components, with their component and
    the list's length m."""
    rooted = members.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lists = (rooted.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("m"))
             .filter("low <> high").select("token", "m"))
    return rooted.join(lists, "token")


def _across(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of entries of a list, of different components and fitting sizes.
    Where both sets have the same list before this one in their order, the pair
    is met there already."""
    a = left.select("token", F.col("node").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"), F.col("root").alias("ra"), F.col("prev").alias("va"))
    b = right.select("token", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"), F.col("root").alias("rb"), F.col("prev").alias("vb"))
    return a.join(b, "token").filter("a <> b and ra <> rb and coalesce(va <> vb, true) and " + _CAN_LINK).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _leaders(entries: DataFrame, turn: int) -> DataFrame:
    """``LEADERS`` entries of each list at most, others in each turn."""
    h = F.xxhash64("node", F.lit(turn))
    return (entries.groupBy("token", F.pmod(h, F.lit(LEADERS)).alias("seat")).agg(F.min(F.struct("pos", h.alias("h"), "node", "n", "root", "prev")).alias("x"))
            .select("token", "x.node", "x.n", "x.pos", "x.root", "x.prev"))


def _close_lists(met: DataFrame, links: DataFrame, labels: DataFrame, docs: DataFrame, doc_nodes: DataFrame, k: int) -> DataFrame:
    """Components after every pair that a list can still link was compared.

    Short lists compare all their pairs across components. Long ones compare
    ``LEADERS`` entries with all others, turn after turn; once the pairs left
    are no more than that (or turns bring nothing), they are all compared."""
    members = stage_table(met.select("token", F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("na").alias("n"), F.col("pa").alias("pos")),
                                                                F.struct(F.col("b").alias("node"), F.col("nb").alias("n"), F.col("pb").alias("pos")))).alias("m"))
                          .select("token", "m.*").distinct(), "members")
    tried = met.filter(_CAN_LINK).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    turn = 0
    while True:
        entries = _spanning(members, labels)
        if turn == 0:  # a set has no more entries than elements
            entries = entries.withColumn("prev", F.lag("token").over(Window.partitionBy("node").orderBy("pos", "token")))
        entries = stage_table(entries, "spanning")
        if turn == 0:
            short = entries.filter(F.col("m") <= 2 * LEADERS)
            members = stage_table(entries.filter(F.col("m") > 2 * LEADERS).select("token", "node", "n", "pos", "prev"), "members")
            entries = entries.filter(F.col("m") > 2 * LEADERS)
        sizes = (entries.groupBy("token", "root").agg(F.count("*").alias("c")).groupBy("token").agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.col("c")).alias("own"))
                 .agg(F.sum((F.col("m") * F.col("m") - F.col("own")) / 2).alias("pairs"), F.sum("m").alias("rows")).first())
        last = turn >= TURNS or (sizes["pairs"] or 0) <= LEADERS * (sizes["rows"] or 0)
        pairs = _across(entries, entries) if last else _across(_leaders(entries, turn), entries)
        if turn == 0:
            pairs = pairs.union(_across(short, short)).distinct()
        pairs = stage_table(pairs.join(tried, ["a", "b"], "left_anti"), "rest")
        if pairs.limit(1).count():
            found = stage_table(check(pairs, docs, doc_nodes, k), "links")
            if found.limit(1).count():
                links = links.union(found)
                labels = components(links)
        if last:
            return labels
        tried, turn = tried.union(pairs.select("a", "b")), turn + 1


# -- operator -----------------------------------------------------------------

def _row_key(docs: DataFrame, id_col: str, text_col: str):
    """A hash of id and text; equal for repeated rows."""
    return F.xxhash64(docs[id_col], docs[text_col])


def _assign(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, key, n, component_id, stays) for every document row; in each
    component the row with the smallest id (then key) stays, and repetitions."""
    spark = docs.sparkSession
    prepare(spark)
    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(docs[id_col].alias("doc_id"), _row_key(docs, id_col, text_col).alias("key"), docs[text_col].alias("text"))
    first = stage_table(source.mapInArrow(_sets_pass(k), f"doc_id {id_type}, key long, node long, n long, element long, times long, map binary"), "sets")
    doc_nodes = first.filter("element is null").select("doc_id", "key", "node", "n", "map")
    text = source.select("text")

    # Distinct set sizes are fewer than words in the longest text; beyond MAX_LIGHT one number does.
    capped = doc_nodes.filter("n > 0").groupBy(F.least("n", F.lit(most(MAX_LIGHT) + 1)).cast("int").alias("n")).agg(F.count("*").alias("docs"), F.sum("n").alias("elements")).collect()
    boundary = choose_boundary({r["n"]: r["docs"] for r in capped})
    elements = sum(r["elements"] for r in capped)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(elements * 0.2 / (2 * FLUSH)) + 1)

    hint = first.filter("element is not null").groupBy("element").agg(F.sum("times").alias("times"))
    levels = hint.groupBy(F.floor(F.log2("times") * 4).cast("int").alias("level")).count().orderBy(F.desc("level")).collect()  # 256 rows at most
    total, low = 0, 256
    for r in levels:
        total += r["count"]
        if total > ORDER_HINTS:
            break
        low = r["level"]
    top = hint.filter(F.floor(F.log2("times") * 4) >= low).toArrow()  # ORDER_HINTS rows at most
    hints = spark.sparkContext.broadcast(_Hints(top["element"].to_numpy().view(np.uint64), top["times"].to_numpy()))

    met = stage_table(text.mapInArrow(_lists_pass(k, boundary, parts, hints), f"part int, entries binary, {_PAIR}")
                      .repartition(parts, "part").mapInArrow(_meet_pass, _PAIR), "lists")
    first_pairs = met.filter(_CAN_LINK).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = check(stage_table(first_pairs, "pairs"), source, doc_nodes, k)
    if boundary:
        links = links.union(light_links(text, k, boundary))
    links = stage_table(links, "links")
    labels = components(links)

    labels = _close_lists(met, links, labels, source, doc_nodes, k)

    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    nodes = doc_nodes.filter("node is not null").groupBy("node").agg(F.min(row).alias("low")).join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = nodes.groupBy("root").agg(F.min("low").alias("first"))
    named = nodes.join(lowest, "root").select("node", "first")
    empty = F.col("node").isNull()
    return doc_nodes.join(named, "node", "left").select(
        "doc_id", "key", "n", F.when(empty, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        (empty | (F.col("key") == F.col("first.key"))).alias("stays"))


def near_duplicate_components(docs: DataFrame, k: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every document row."""
    return _assign(docs, k, id_col, text_col).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, k: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of every component, the one with the smallest id (null ids
    last); documents with empty sets all stay. All columns as they were."""
    rows = stage_table(_assign(docs, k, id_col, text_col).select("key", "n", "stays"), "components")
    repeated = rows.filter("stays and n > 0").groupBy("key").count().filter("count > 1").select("key")
    gone = rows.filter("not stays").select("key").union(repeated).distinct()
    key = _row_key(docs, id_col, text_col)
    kept = docs.join(gone, key == gone["key"], "left_anti")
    if repeated.limit(1).count():
        again = docs.join(repeated, key == repeated["key"], "left_semi")
        number = F.row_number().over(Window.partitionBy(key).orderBy(F.lit(1)))
        kept = kept.union(again.select(*[again[c] for c in again.columns], number.alias("__copy")).filter(F.col("__copy") == 1).drop("__copy"))
    return kept
