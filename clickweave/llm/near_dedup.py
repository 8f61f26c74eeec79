"""Near-duplicate detection by a chosen-path similarity join.

Documents are sets of word shingles.  Sets that are equal form one class; the
join runs on one representative per class.  A class has a signature of
``COORDINATES`` minwise tokens.  Each of ``TREES`` independent trees branches
the representatives: a node picks one or two coordinates (4/3 on average, the
inverse of the similarity) from its own random choice, and its members go to
the child named by (coordinate, minwise token), so similar sets stay together.

Two rounds use the nodes.  First every member is set against the most central
member of its node (the one closest to the node's most frequent tokens); each
document's best such pair is confirmed on the full shingle sets, which joins
most groups of copies with one pair per document.  Then nodes that still hold members of
different components are branched down to ``LEAF`` members, and a leaf is
compared exhaustively: first on 8 bits of each coordinate, which only tells
whose sets are needed (members with an estimate from over 4 standard
deviations below the threshold on to one of another component); then their
full shingle sets, whose intersections a leaf counts all at once.  A node
emits a forest of confirmed links, one row per member at most, however many
pairs lie next to the threshold.  Nodes of up to ``TASK_MEMBERS`` members do
this inside one task; larger ones are branched by Spark, level by level, so no
node has to fit in a task.

Components are those of confirmed links only.  Recall: a pair at the threshold
shares a first branching of a tree with probability 3/4 or more, and stays
together below it as a critical branching process does (after ten levels in
about one third of the trees); with 16 first branchings it is missed in about
(2/3) ** 16 = 0.2 % of the cases if the node is that deep, and only matters if
no other path of links joins its ends.

Defined results: a text without words, empty or null, has no shingles and is
linked with nothing; a text with fewer words than a shingle is one shingle; a
row with a null id is linked with nothing, its component is null and it is
kept; rows repeated under one id count as one document (a link of any of them
is the id's); an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm import words as wd
from clickweave.llm.common import batch, components, prepare, written

SHINGLE = 5
#: Similarity in hundredths.
THRESHOLD = 75
COORDINATES = 128
TREES = 12
LEAF = 64
#: Levels of branching, after which the members of a node (alike in all of them) are compared by pivots.
DEPTH = 30
#: Columns of a leaf's set matrix held at once.
COLUMNS = 1 << 15
TASK_MEMBERS = 20_000
#: Estimates from which a pair may be similar, and from which a large node's members surely are in its pivot's group.
PROPOSED, SURE = 0.58, 0.86
#: Ids broadcast to a text scan at most (8 bytes each); more are joined by shuffle.
BROADCAST_IDS = 1_000_000
#: Pairs of one representative that are confirmed in one group.
PAIRS_PER_GROUP = 500

_U = np.uint64
_ODD = wd._constants(11, COORDINATES) | _U(1)
_XOR = wd._constants(12, COORDINATES)


# ---- sets and signatures ---------------------------------------------------------------


def shingle_sets(texts: pa.Array, k: int = SHINGLE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per slice: first row, shingle hashes (not distinct) and their borders by document."""
    for w in wd.slices(texts, lower=True):
        h = w.hashes(3)
        count = np.diff(w.offset)
        size = np.where(count >= k, count - k + 1, np.minimum(count, 1))
        border = np.concatenate([[0], np.cumsum(size)])
        out = np.empty(border[-1], np.uint64)
        long = count >= k
        if long.any():
            at = wd.window_starts(w, k)
            out[np.repeat(long, size)] = wd.windows(h, k, 5)[at]
        for d in np.flatnonzero((count > 0) & ~long):
            n = int(count[d])
            out[border[d]] = wd.windows(h[w.offset[d]:w.offset[d + 1]], n, 5 + n)[0]
        yield w.first, out, border


def signatures(hashes: np.ndarray, border: np.ndarray) -> np.ndarray:
    """Minwise tokens (32 bits) of the documents that have shingles."""
    starts = border[:-1][np.diff(border) > 0]
    out = np.empty((len(starts), COORDINATES), np.uint32)
    for i in range(COORDINATES):
        out[:, i] = np.minimum.reduceat(((hashes ^ _XOR[i]) * _ODD[i]) >> _U(32), starts)
    return out


_SETS = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("sig", pa.binary())])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = b.column(0)
        for first, hashes, border in shingle_sets(b.column(1)):
            n = len(border) - 1
            sizes, digests, sigs = np.zeros(n, np.int64), [None] * n, [None] * n
            full = np.flatnonzero(np.diff(border))
            if len(full):
                sig = signatures(hashes, border)
                for row, d in enumerate(full.tolist()):
                    distinct = np.unique(hashes[border[d]:border[d + 1]])
                    sizes[d] = len(distinct)
                    digests[d] = hashlib.blake2b(distinct.tobytes(), digest_size=16).digest()
                    sigs[d] = sig[row].tobytes()
            yield batch(_SETS, [ids.slice(first, n), sizes, digests, sigs])


# ---- the trees -----------------------------------------------------------------------------


def choices(node: int, depth: int) -> list[int]:
    """The coordinates a node branches on: one, or two in a third of the nodes."""
    x = wd.mix(np.array([node], np.uint64) + _U(depth * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF))
    r = int(x[0])
    first = r % COORDINATES
    if (r >> 20) % 3:
        return [first]
    return [first, (first + 1 + (r >> 40) % (COORDINATES - 1)) % COORDINATES]


def child_nodes(node: int, coordinate: int, tokens: np.ndarray) -> np.ndarray:
    seed = wd.mix(np.array([node], np.uint64) ^ _U((coordinate + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    return wd.mix(tokens.astype(np.uint64) * _U(0xD6E8FEB86659FD93) + seed)


class Groups:
    """Union-find over the members of one node."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def of(self, members: np.ndarray) -> np.ndarray:
        up = self.up[members]
        while True:
            above = self.up[up]
            if (above == up).all():
                return up
            up = above

    def join(self, i: int, others: np.ndarray) -> None:
        roots = np.unique(np.append(self.of(others), self.of(np.array([i]))))
        self.up[roots] = roots[0]


def centrality(sketch: np.ndarray) -> np.ndarray:
    """Share of coordinates in which a member has the node's most frequent token."""
    common = np.array([np.bincount(c, minlength=256).argmax() for c in sketch.T], np.uint8)
    return (sketch == common).mean(1)


def star(ids: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, central id, estimate) for the members similar to the most central one."""
    middle = np.lexsort((ids, -centrality(sketch)))[0]
    alike = (sketch == sketch[middle]).mean(1)
    near = np.flatnonzero((alike >= PROPOSED) & (ids != ids[middle]))
    return ids[near], np.full(len(near), ids[middle]), alike[near]


def leaves(node: int, sketch: np.ndarray, groups: Groups) -> Iterator[np.ndarray]:
    """Members that are compared with each other, as long as they are of several groups when their turn comes."""
    stack = [(node, np.arange(len(sketch)), 1)]
    while stack:
        node, members, depth = stack.pop()
        if len(np.unique(groups.of(members))) < 2:
            continue
        if len(members) <= LEAF or depth >= DEPTH:
            yield members
            continue
        for c in choices(node, depth):
            tokens = sketch[members, c]
            for t in np.unique(tokens).tolist():
                part = members[tokens == t]
                if len(part) > 1:
                    stack.append((int(child_nodes(node, c, np.array([t]))[0]), part, depth + 1))


def _groups(component: np.ndarray) -> Groups:
    groups = Groups(len(component))
    _, first, inverse = np.unique(component, return_index=True, return_inverse=True)
    groups.up = first[inverse]
    return groups


def involved(node: int, ids: np.ndarray, component: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """Ids of the members that look similar to a member of another component in some leaf."""
    groups, found = _groups(component), np.zeros(len(ids), bool)
    for members in leaves(node, sketch, groups):
        if len(members) > LEAF:
            found[members] = True  # alike in all levels
            continue
        of = groups.of(members)
        alike = (sketch[members][:, None, :] == sketch[members][None, :, :]).mean(2)
        found[members] |= ((alike >= PROPOSED) & (of[:, None] != of[None, :])).any(1)
    return ids[found]


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of different sets (of distinct hashes)."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1  # hashes of one set only add nothing
    owner, column = owner[shared], (np.cumsum(count > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((len(sets), len(sets)), np.float64)
    for start in range(0, int((count > 1).sum()), COLUMNS):
        i, j = np.searchsorted(column, (start, start + COLUMNS))
        have = np.zeros((len(sets), min(COLUMNS, int((count > 1).sum()) - start)), np.float32)
        have[owner[i:j], column[i:j] - start] = 1
        both += have @ have.T
    return both.astype(np.int64)


def forest(node: int, ids: np.ndarray, component: np.ndarray, sketch: np.ndarray, sets: list[np.ndarray],
           threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Confirmed links that join the components of a node, members - 1 at most."""
    groups, sizes = _groups(component), np.array([len(x) for x in sets])
    a: list[int] = []
    b: list[int] = []

    def join(i: int, j: int) -> None:
        if groups.of(np.array([i]))[0] != groups.of(np.array([j]))[0]:
            groups.join(i, np.array([j]))
            a.append(min(ids[i], ids[j]))
            b.append(max(ids[i], ids[j]))

    for members in leaves(node, sketch, groups):
        if len(members) <= LEAF:
            both = overlaps([sets[i] for i in members])
            n = sizes[members]
            linked = 100 * both >= threshold * (n[:, None] + n[None, :] - both)
            for i, j in zip(*np.nonzero(np.triu(linked, 1)), strict=True):
                join(members[i], members[j])
            continue
        left = members
        while len(np.unique(groups.of(left))) > 1:  # each pivot against all that are left, in blocks
            pivot, left = left[0], left[1:]
            others = left[groups.of(left) != groups.of(np.array([pivot]))[0]]
            for k in range(0, len(others), LEAF):
                block = others[k:k + LEAF]
                both = np.array([len(np.intersect1d(sets[pivot], sets[i], assume_unique=True)) for i in block])
                for i in block[100 * both >= threshold * (sizes[pivot] + sizes[block] - both)]:
                    join(pivot, i)
    return np.array(a, np.int64), np.array(b, np.int64)


_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _by_node(search, schema: pa.Schema, with_sets: bool = False):
    """Rows (node, id, component, sketch, and sets where asked) in order of node; ``search`` gives the columns of a
    node's result."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, ...] | None = None

        def flush(nodes, ids, component, sketch, *sets):
            border = np.flatnonzero(np.diff(nodes)) + 1
            found = []
            for i, j in zip([0, *border.tolist()], [*border.tolist(), len(nodes)], strict=True):
                if j - i > 1:
                    found += search(int(nodes[i:i + 1].view(np.uint64)[0]), ids[i:j], component[i:j], sketch[i:j], *(x[i:j] for x in sets))
            if found:
                yield batch(schema, [np.concatenate(x) for x in zip(*found, strict=True)])

        for b in batches:
            now = (*(np.asarray(b.column(i)) for i in range(3)),
                   np.frombuffer(b"".join(b.column(3).to_pylist()), np.uint8).reshape(-1, COORDINATES))
            if with_sets:
                own = np.empty(len(now[0]), object)
                own[:] = [np.frombuffer(x, np.uint64) for x in b.column(4).to_pylist()]
                now = (*now, own)
            held = now if held is None else tuple(np.concatenate(x) for x in zip(held, now, strict=True))
            last = int(np.searchsorted(held[0], held[0][-1]))  # the last node may go on in the next batch
            if last:
                yield from flush(*(x[:last] for x in held))
                held = tuple(x[last:] for x in held)
        if held is not None:
            yield from flush(*held)
    return run


_STARS = pa.schema([("id", pa.int64()), ("middle", pa.int64()), ("alike", pa.float64())])
_star_search = _by_node(lambda node, ids, component, sketch: [star(ids, sketch)], _STARS)
_INVOLVED = pa.schema([("node", pa.int64()), ("id", pa.int64())])


def _involved_rows(node, ids, component, sketch):
    found = involved(node, ids, component, sketch)
    return [(np.full(len(found), np.uint64(node)).view(np.int64), found)]


_involved_search = _by_node(_involved_rows, _INVOLVED)
_forest_search = _by_node(lambda node, ids, component, sketch, sets: [forest(node, ids, component, sketch, list(sets))], _PAIRS, True)


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("id", pa.int64()), ("shingles", pa.binary())])
    for b in batches:
        for first, hashes, border in shingle_sets(b.column(1)):
            n = len(border) - 1
            yield batch(schema, [b.column(0).slice(first, n), [np.unique(hashes[border[d]:border[d + 1]]).tobytes() for d in range(n)]])


def _first_nodes(trees: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("node", pa.int64()), ("id", pa.int64())])
        roots = [(t, c) for t in range(trees) for c in choices(t, 0)]
        for b in batches:
            sig = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(-1, COORDINATES)
            ids = np.asarray(b.column(0))
            for t, c in roots:
                yield batch(schema, [child_nodes(t, c, sig[:, c]).view(np.int64), ids])
    return run


def _branch(depth: int):
    """Rows (node, id, sig, pivot, pivot_sig) of large nodes to their children, and pairs with the pivot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("node", pa.int64()), ("id", pa.int64()), ("pivot", pa.int64()), ("alike", pa.float64())])
        for b in batches:
            nodes, ids, pivots = (np.asarray(b.column(i)) for i in (0, 1, 3))
            sig, psig = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint32).reshape(-1, COORDINATES) for i in (2, 4))
            alike = (sig.astype(np.uint8) == psig.astype(np.uint8)).mean(1)
            near = (alike >= PROPOSED) & (ids != pivots)
            out = [(np.zeros(near.sum(), np.int64), ids[near], pivots[near], alike[near])]
            for node in np.unique(nodes).tolist():
                here = np.flatnonzero(nodes == node)
                for c in choices(node & 0xFFFFFFFFFFFFFFFF, depth):
                    kids = child_nodes(node & 0xFFFFFFFFFFFFFFFF, c, sig[here, c]).view(np.int64)
                    out.append((kids, ids[here], None, alike[here]))
            for o in out:
                if len(o[0]):
                    yield batch(schema, [o[0], o[1], pa.nulls(len(o[0]), pa.int64()) if o[2] is None else o[2], o[3]])
    return run


def tree_nodes(classes: DataFrame, trees: int = TREES, task_members: int = TASK_MEMBERS) -> tuple[DataFrame | None, list[DataFrame]]:
    """Members (node, id) of the nodes of 2 to ``task_members``, and for each level of larger ones
    the pairs (id, middle, alike) with the node's smallest id."""
    sigs = classes.select("rep", "sig")
    rows = sigs.mapInArrow(_first_nodes(trees), "node long, id long").withColumn("alike", F.lit(0.0))
    nodes, stars, depth = [], [], 1
    while True:
        # a child of a large node needs no search where all its members surely belong to the pivot's group
        sizes = written(rows.groupBy("node").agg(F.count("*").alias("c"), F.min("id").alias("pivot"), F.min("alike").alias("least"))
                        .filter((F.col("c") > 1) & (F.col("least") < SURE)).select("node", "c", "pivot"), "near-nodes")
        if sizes.isEmpty():
            break
        small = sizes.filter(F.col("c") <= task_members).select("node")
        nodes.append(written(rows.select("node", "id").join(small, "node"), "near-members"))
        large = sizes.filter(F.col("c") > task_members)
        if large.isEmpty():
            break
        # at most rows / task_members nodes are large
        heads = written(large.join(sigs.withColumnRenamed("rep", "pivot").withColumnRenamed("sig", "pivot_sig"), "pivot"), "near-large")
        members = rows.select("node", "id").join(F.broadcast(heads.select("node", "pivot", "pivot_sig")), "node")
        members = members.join(sigs.withColumnRenamed("rep", "id"), "id").select("node", "id", "sig", "pivot", "pivot_sig")
        branched = written(members.mapInArrow(_branch(depth), "node long, id long, pivot long, alike double"), "near-branch")
        stars.append(branched.filter("pivot IS NOT NULL").select("id", F.col("pivot").alias("middle"), "alike"))
        rows = branched.filter("pivot IS NULL").select("node", "id", "alike")
        depth += 1
    out = None
    for n in nodes:
        out = n if out is None else out.unionByName(n)
    return out, stars


def links(classes: DataFrame, docs: DataFrame, trees: int = TREES, task_members: int = TASK_MEMBERS) -> DataFrame:
    """Confirmed pairs (a, b) of representatives that connect all similar ones."""
    none = classes.sparkSession.createDataFrame([], "a long, b long")
    members, stars = tree_nodes(classes, trees, task_members)
    if members is None:
        return none
    sketches = written(classes.select("rep", "sig").mapInArrow(_cut_sketch, "id long, sketch binary"), "near-sketches")

    def search(rows: DataFrame, how, schema: str, sets: DataFrame | None = None) -> DataFrame:
        rows = rows.join(sketches, "id").select("node", "id", "component", "sketch")
        if sets is not None:
            rows = rows.join(sets, "id").select("node", "id", "component", "sketch", "shingles")
        return rows.repartition("node").sortWithinPartitions("node").mapInArrow(how, schema)

    found = search(members.withColumn("component", F.col("id")), _star_search, "id long, middle long, alike double")
    for more in stars:
        found = found.unionByName(more)
    best = found.groupBy("id").agg(F.max(F.struct("alike", (-F.col("middle")).alias("m"))).alias("best")).select(
        "id", (-F.col("best.m")).alias("middle"))
    first = written(confirm(best.select(F.least("id", "middle").alias("a"), F.greatest("id", "middle").alias("b")).distinct(), docs), "near-first")

    known = written(components(first), "near-known")
    labelled = members.join(known, members["id"] == known["node"], "left").select(
        members["node"], "id", F.coalesce("component", "id").alias("component"))
    labelled = written(labelled, "near-labelled")
    mixed = labelled.groupBy("node").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("node")
    rest = labelled.join(written(mixed, "near-mixed"), "node")
    near = written(search(rest, _involved_search, "node long, id long"), "near-involved")
    near = written(near.join(labelled, ["node", "id"]), "near-compared")
    ends = written(near.select(F.col("id").alias("doc_id")).distinct(), "near-compared-ids")
    few = ends.count() <= BROADCAST_IDS
    sets = written(docs.join(F.broadcast(ends) if few else ends, "doc_id", "left_semi").select("doc_id", "text")
                   .mapInArrow(_full_sets, "id long, shingles binary").filter(F.length("shingles") > 0), "near-full-sets")
    joined = first.unionByName(written(search(near, _forest_search, "a long, b long", sets).distinct(), "near-forest"))
    if stars:  # pairs with the pivots of large nodes, where they still are across components
        ends = known.select("node", "component")
        more = found.select(F.least("id", "middle").alias("a"), F.greatest("id", "middle").alias("b"))
        more = more.join(ends.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left").join(
            ends.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
        more = more.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b").distinct()
        joined = joined.unionByName(confirm(more, docs))
    return joined


def _cut_sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("id", pa.int64()), ("sketch", pa.binary())])
    for b in batches:
        sig = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(-1, COORDINATES).astype(np.uint8)
        yield batch(schema, [b.column(0), [x.tobytes() for x in sig]])


# ---- confirmation -------------------------------------------------------------------------------


def _confirm(k: int, threshold: int):
    """Rows (a, part, b, text) ordered by (a, part), the text of a itself first (b null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads: list[np.ndarray] = []
        current = None
        for batch_ in batches:
            a, part, b = (batch_.column(i).to_pylist() for i in range(3))
            good = []
            for first, hashes, border in shingle_sets(batch_.column(3), k):
                for d in range(len(border) - 1):
                    i = first + d
                    own = np.unique(hashes[border[d]:border[d + 1]])
                    if (a[i], part[i]) != current:
                        current, heads = (a[i], part[i]), []
                    if b[i] is None:
                        heads.append(own)
                        continue
                    for head in heads:
                        both = len(np.intersect1d(head, own, assume_unique=True))
                        if 100 * both >= threshold * (len(head) + len(own) - both):
                            good.append((a[i], b[i]))
                            break
            if good:
                yield batch(_PAIRS, [[x for x, _ in good], [y for _, y in good]])
    return run


def confirm(pairs: DataFrame, docs: DataFrame, k: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """The pairs whose full shingle sets are similar enough.  ``docs``: doc_id, text."""
    pairs = written(pairs, "near-proposed")
    ends = written(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "near-ends")
    few = ends.count() <= BROADCAST_IDS
    texts = written(docs.join(F.broadcast(ends) if few else ends, "doc_id", "left_semi"), "near-texts")
    # a representative with many pairs is confirmed in several groups
    many = pairs.groupBy("a").agg(F.count("*").alias("c")).filter(F.col("c") > PAIRS_PER_GROUP)
    many = written(many.select("a", F.ceil(F.col("c") / PAIRS_PER_GROUP).alias("parts")), "near-many")
    placed = pairs.join(many, "a", "left").select("a", "b", F.expr("pmod(xxhash64(b), coalesce(parts, 1L))").alias("part"))
    placed = written(placed, "near-placed")
    heads = placed.select("a", "part").distinct().join(texts.withColumnRenamed("doc_id", "a"), "a").select(
        "a", "part", F.lit(None).cast("long").alias("b"), "text")
    others = placed.join(texts.withColumnRenamed("doc_id", "b"), "b").select("a", "part", "b", "text")
    rows = heads.unionByName(others).repartition("a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("b"))
    return rows.mapInArrow(_confirm(k, threshold), "a long, b long").distinct()


# ---- the operator ------------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", trees: int = TREES,
                    task_members: int = TASK_MEMBERS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per input row."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sets = written(docs.mapInArrow(_sets, "doc_id long, n_shingles long, digest binary, sig binary"), "near-sets")
    real = sets.filter("doc_id IS NOT NULL AND digest IS NOT NULL")
    classes = written(real.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.min("sig").alias("sig")), "near-classes")
    pairs = links(classes, docs, trees, task_members)
    # rows of one id with different texts join the classes of these texts
    same_id = real.select("doc_id", "digest").join(classes.select("digest", "rep"), "digest").filter("doc_id <> rep")
    shared = same_id.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"), "digest")
    repeated = real.groupBy("doc_id").agg(F.countDistinct("digest").alias("c")).filter("c > 1").select(F.col("doc_id").alias("a"))
    pairs = pairs.unionByName(shared.join(repeated, "a", "left_semi").select("a", "b"))
    found = components(pairs)
    named = written(classes.select("digest", "rep").join(found, classes["rep"] == found["node"], "left")
                    .select("digest", F.coalesce("component", "rep").alias("component")), "near-components")
    out = sets.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + 4], ' ')) AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, least(len(ws), 1)) + 1)) AS i FROM w)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM w UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(b) AS component_id, w.doc_id = min(b) AS kept
FROM w LEFT JOIN sizes USING (doc_id) JOIN reach ON reach.a = w.doc_id GROUP BY w.doc_id, n
"""
