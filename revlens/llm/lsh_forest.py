"""Near-duplicate detection with an LSH forest.

1. One pass gives each document its set of distinct k-word shingles as 64-bit hashes,
   a 128-bit key of the whole set and a MinHash signature of ``SIGNATURE`` values.
   Documents with equal sets form a class; its smallest id stands for it.
2. The forest holds each class in ``TREES`` orders of its signature.  The rows of all trees
   are range-partitioned and sorted by (tree, ordered signature), so a region where a
   third of all rows share a prefix spreads over many partitions.  Each row meets the ``NEIGHBOURS`` rows
   before it, those with the longest common prefixes; in a dense region these share long
   prefixes and in a sparse one short ones, so the depth adapts by itself.  Neighbours with a common prefix of
   ``MIN_DEPTH`` whose sketches agree well enough for a similarity near the threshold are
   candidates.  Rows at partition borders meet in a second, small pass.
3. Candidates are joined to regions (connected components).  Inside a region no link is lost, no list of
   pairs is made, and no task holds more than two blocks of at most ``block_docs`` members; it counts common shingles on the full sets and
   returns what the true links join (fewer rows than its members).  A region of one block is done in one group.  A larger one
   is first thinned: each block is linked by itself, then one member of each linked group meets those of other groups, as long as this
   at least halves the groups, so that a crowd of near copies becomes one group after copying each set a few times.  Where several
   groups are left, members meet on the rarest shingles of their sets (the prefix that two sets of enough similarity
   must share a shingle of), shingles whose members are all of one group aside; a list of more than a block is cut into blocks, any two of which meet.
   Should these lists copy more sets than any two blocks of the region would, the region's blocks meet instead: both ways find every link.
4. Components of the true links give the result.

What can be missed is a link whose two documents end up in different regions: none of the
``TREES`` trees (each with a chance of about 0.41 at a similarity of exactly 0.75, so 5e-8
over 32) and no third document brings them together.

Rows: a text with fewer than k words has its whole word sequence as only shingle; a null or empty text, or one
of blanks, has no shingles and no links.  Rows that share a doc_id are one document:
what one of them links with, the others reach; their sets are dealt over the blocks like those of other ids, and exact repeats
are dropped in each task that reads them.  Null ids join the class of an equal set, but
stand for no class; alone, their component is null and they are kept.  Ties and repeated rows make one class.
An empty table gives no rows.  Only the named id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import connected_components, materialize, text_key
from revlens.llm.textops import SPACED, grams, text_chunks, words

SIGNATURE = 96
TREES = 32
DEPTH = 8
MIN_DEPTH = 3
NEIGHBOURS = 3
SLOTS = 1 << 18  # counters by which shingles are told common from rare

_rng = np.random.Generator(np.random.PCG64(97))
_A = (_rng.integers(0, 2**31, SIGNATURE) * 2 + 1).astype(np.uint32)
_B = _rng.integers(0, 2**32, SIGNATURE).astype(np.uint32)
#: tree t leads with three values of its own; the rest of its order is drawn from the others
_ORDERS = np.stack([np.r_[3 * t:3 * t + 3, _rng.choice(np.delete(np.arange(SIGNATURE), np.arange(3 * t, 3 * t + 3)), DEPTH - 3, replace=False)]
                    for t in range(TREES)])
_SKETCH = SIGNATURE // 4  # two bits a value
_KEY = 4 * DEPTH + _SKETCH


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Ascending distinct shingle hashes of each text of a batch."""
    h, wo = words(data, offs, SPACED)
    g = grams(h, k)
    for a, b in zip(wo[:-1].tolist(), wo[1:].tolist()):
        if b - a >= k:
            yield np.unique(g[a:b - k + 1])
        else:
            yield grams(h[a:b], b - a)[:1] if b > a else np.zeros(0, np.uint64)


def signature(s: np.ndarray) -> np.ndarray:
    x = (s >> np.uint64(32)).astype(np.uint32)
    out = np.full(SIGNATURE, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 4096):
        v = x[None, i:i + 4096] * _A[:, None]
        v += _B[:, None]
        v ^= v >> np.uint32(15)
        np.minimum(out, v.min(axis=1), out=out)
    return out


def _signatures(docs: DataFrame, k: int, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offs in text_chunks(batch.column("text")):
                size, keys, sigs = [], [], []
                for s in shingle_sets(data, offs, k):
                    size.append(len(s))
                    keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    sigs.append(signature(s).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(i, j - i), pa.array(size, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary()),
                     batch.column("text_key").slice(i, j - i)], names=["id", "n_shingles", "set_key", "sig", "text_key"])

    docs = docs.withColumn("text_key", text_key("text"))
    return docs.mapInArrow(run, f"id {kind}, n_shingles long, set_key binary, sig binary, text_key long")


def _forest(classes: DataFrame, kind: str) -> DataFrame:
    """One row per class and tree; the key sorts as the tree's order of the signature, then a sketch of the whole of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 2048):
                part = batch.slice(i, 2048)
                sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint32).reshape(-1, SIGNATURE)
                low = (sig & np.uint32(3)).astype(np.uint8).reshape(len(sig), _SKETCH, 4)
                sketch = low[:, :, 0] | low[:, :, 1] << 2 | low[:, :, 2] << 4 | low[:, :, 3] << 6
                for t in range(TREES):
                    lead = np.ascontiguousarray(sig[:, _ORDERS[t]].astype(">u4")).view(np.uint8).reshape(len(sig), 4 * DEPTH)
                    flat = np.concatenate([lead, sketch], axis=1).tobytes()
                    key = pa.Array.from_buffers(pa.binary(_KEY), len(sig), [None, pa.py_buffer(flat)]).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(sig), t, np.int32)), key, part.column("id")],
                                                     names=["tree", "key", "id"])

    return classes.select("id", "sig").mapInArrow(run, f"tree int, key binary, id {kind}")


def _chain_heads(ids: pa.Array, linked: np.ndarray) -> np.ndarray:
    """For each row the row with the smallest id of its chain; ``linked``: rows that belong to the chain of the row before."""
    order = pc.sort_indices(ids).to_numpy()
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    begins = np.ones(len(ids), bool)
    begins[linked] = False
    return order[np.minimum.reduceat(rank, np.flatnonzero(begins))][np.cumsum(begins) - 1].astype(np.int64)


def _neighbours(rows: DataFrame, kind: str, least: int, border: bool) -> DataFrame:
    """Candidates among sorted rows, each with the rows just before it in its partition; with ``border`` also the rows at both ends.

    Only what the candidates connect is used.  So each chain of adjacent candidates is returned as its
    smallest id beside every other one, and farther candidates as the smallest ids of the two chains they join:
    trees that see the same group then name the same pairs, and components are found in few rounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None

        def ends(table, n=None):
            pick = table.slice(0, NEIGHBOURS) if n is None else table.slice(max(0, len(table) - NEIGHBOURS))
            null = pa.nulls(len(pick), pick.column("id").type)
            return pa.RecordBatch.from_arrays([pick.column("id").combine_chunks(), null, pick.column("tree").combine_chunks(),
                                               pick.column("key").combine_chunks()], names=["a", "b", "tree", "key"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if kept is None and border:
                yield ends(table)
            if kept is not None:
                table = pa.concat_tables([kept, table])
            n, old = len(table), 0 if kept is None else len(kept)
            key = np.frombuffer(b"".join(table.column("key").to_pylist()), np.uint8).reshape(n, _KEY)
            lead, sketch = np.ascontiguousarray(key[:, :4 * DEPTH]).view(np.uint32), key[:, 4 * DEPTH:]
            tree, ids = table.column("tree").to_numpy(), table.column("id").combine_chunks()
            head = np.zeros(n, np.int64)  # row with the smallest id of each row's chain
            for lag in range(1, NEIGHBOURS + 1):
                at = np.arange(lag, n)
                ok = (tree[at] == tree[at - lag]) & (lead[at, :MIN_DEPTH] == lead[at - lag, :MIN_DEPTH]).all(axis=1)
                at = at[ok]
                x = sketch[at] ^ sketch[at - lag]
                differ = np.bitwise_count((x | x >> 1) & 0x55).sum(axis=1)
                at = at[SIGNATURE - differ >= least]
                if lag == 1:
                    head = _chain_heads(ids, at)
                    near = np.flatnonzero(head != np.arange(n))
                    pairs = np.stack([near, head[near]])
                else:
                    at = at[at >= old]  # links among the rows carried over are out already
                    pairs = np.stack([head[at], head[at - lag]])
                    pairs = np.unique(pairs[:, pairs[0] != pairs[1]], axis=1)
                if pairs.size:
                    a, b = (ids.take(pa.array(x)) for x in pairs)
                    yield pa.RecordBatch.from_arrays([a, b, pa.nulls(len(a), pa.int32()), pa.nulls(len(a), pa.binary())],
                                                     names=["a", "b", "tree", "key"])
            kept = table.slice(max(0, n - NEIGHBOURS))
        if kept is not None and border:
            yield ends(kept, 1)

    return rows.mapInArrow(run, f"a {kind}, b {kind}, tree int, key binary")


def candidate_pairs(spark: SparkSession, classes: DataFrame, kind: str, least: int) -> DataFrame:
    """Distinct candidate pairs ``(a, b)`` of class representatives."""
    order = ["tree", "key", "id"]
    rows = _forest(classes, kind).repartitionByRange(*order).sortWithinPartitions(*order)
    first = materialize(spark, _neighbours(rows, kind, least, True), "neighbours")
    # a few rows per partition of the forest; only rows of one tree need to meet
    edge = first.where("b is null").select("tree", "key", F.col("a").alias("id")).repartition("tree").sortWithinPartitions(*order)
    pairs = first.where("b is not null").select("a", "b").unionByName(_neighbours(edge, kind, least, False).select("a", "b"))
    return pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _links(codes: list[np.ndarray], block: np.ndarray, names: list, percent: int) -> list[tuple]:
    """What the true links between the members of two blocks (of one, if all have the same number) join: each group's smallest name beside every other."""
    n = len(codes)
    size = np.array([len(c) for c in codes])
    every = np.concatenate(codes)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    start = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
    count = np.diff(np.r_[start, len(every)])
    of = np.repeat(np.arange(len(start)), count)  # posting list of each (sorted) entry
    shared = count[of] > 1
    at = np.flatnonzero(shared)
    by = at[np.argsort(owner[at], kind="stable")]  # shared entries, by member
    cut = np.searchsorted(owner[by], np.arange(n + 1))
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    one = block.min() == block.max()
    for i in range(n):
        lists = of[by[cut[i]:cut[i + 1]]]
        if not len(lists):
            continue
        reps, firsts = count[lists], start[lists]
        at = np.repeat(firsts - (np.cumsum(reps) - reps), reps) + np.arange(reps.sum())
        common = np.bincount(owner[at], minlength=n)
        near = np.flatnonzero(100 * common >= percent * (size[i] + size - common))
        for j in near[near > i]:
            if one or block[j] != block[i]:
                a, b = find(i), find(int(j))
                if names[b] < names[a]:
                    a, b = b, a
                root[b] = a  # a root has the smallest name of its group
    return [(names[i], names[find(i)]) for i in range(n) if find(i) != i]


_GROUP = ("region", "part", "p", "q")


def _verified(members: DataFrame, kind: str, percent: int) -> DataFrame:
    """True links of sets that meet in a group (region, part, p, q); ``members`` also has block, id, row, set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, codes, block, names, last = None, [], [], [], None

        def finish():
            found = _links(codes, np.array(block), names, percent) if len(codes) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], id_type), pa.array([x[1] for x in found], id_type)],
                                              names=["a", "b"])

        for batch in batches:
            id_type = batch.column("id").type
            cols = [batch.column(c).to_pylist() for c in (*_GROUP, "block", "id", "row")]
            for (*key, own, name, row), s in zip(zip(*cols), batch.column("set")):
                if key != group:
                    if group is not None:
                        yield finish()
                    group, codes, block, names, last = key, [], [], [], None
                if (name, row) == last:
                    continue  # the same row again
                last = name, row
                codes.append(np.frombuffer(s.as_buffer(), np.uint64).copy())
                block.append(own)
                names.append(name)
        if group is not None:
            yield finish()

    dealt = members.select(*_GROUP, "block", "id", "row", "set").repartition(*_GROUP).sortWithinPartitions(*_GROUP, "id", "row")
    return dealt.mapInArrow(run, f"a {kind}, b {kind}")


def _sets(texts: DataFrame, kind: str, k: int, remembered: int = 1 << 16) -> DataFrame:
    """Shingle sets of the rows that stand for classes; a task gives a repeated row once per ``remembered`` distinct ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            fresh = []
            for i, row in enumerate(zip(batch.column("id").to_pylist(), batch.column("row").to_pylist())):
                if row not in seen:
                    fresh.append(i)
                    seen.add(row)
            if len(seen) > remembered:
                seen.clear()
            batch = batch.take(pa.array(fresh, pa.int64()))
            for i, j, data, offs in text_chunks(batch.column("text")):
                own = [x.tobytes() for x in shingle_sets(data, offs, k)]
                cols = [batch.column(c).slice(i, j - i) for c in ("region", "block", "blocks", "id", "row")]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(own, pa.binary())], names=["region", "block", "blocks", "id", "row", "set"])

    return texts.mapInArrow(run, f"region {kind}, block int, blocks int, id {kind}, row long, set binary").where("octet_length(set) > 0")


def _slot_counts(sets: DataFrame) -> np.ndarray:
    """How many members hold the shingles of each of ``SLOTS`` slots; at most ``SLOTS`` numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for s in batch.column("set"):
                np.add.at(total, np.frombuffer(s.as_buffer(), np.uint64) % np.uint64(SLOTS), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["slot", "n"])

    counts = np.zeros(SLOTS, np.int64)
    for slot, n in sets.select("set").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        counts[slot] = n
    return counts


def _prefixes(sets: DataFrame, kind: str, percent: int) -> DataFrame:
    """The rarest shingles of each set, so many that two sets of enough similarity share one of them.

    Of ``n`` shingles a link needs ``o = ceil(percent * n / 100)`` in common, so under any one order of all shingles the first
    ``n - o + 1`` of both sets have one in common.  The order is by the count of the shingle's slot, then by hash."""
    counts = sets.sparkSession.sparkContext.broadcast(_slot_counts(sets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = counts.value
        for batch in batches:
            at, out, size = [], [], []
            for i, s in enumerate(batch.column("set")):
                s = np.frombuffer(s.as_buffer(), np.uint64)
                first = s[np.lexsort((s, common[s % np.uint64(SLOTS)]))][:len(s) + (-percent * len(s) // 100) + 1]
                at.append(np.full(len(first), i))
                out.append(first.view(np.int64))
                size.append(np.full(len(first), len(s)))
            if at:
                at = pa.array(np.concatenate(at))
                cols = [batch.column(c).take(at) for c in ("region", "grp", "id", "row")]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(np.concatenate(out)), pa.array(np.concatenate(size))],
                                                 names=["region", "grp", "id", "row", "part", "n"])

    return sets.select("region", "grp", "id", "row", "set").mapInArrow(run, f"region {kind}, grp {kind}, id {kind}, row long, part long, n long")


def _meet(rows: DataFrame) -> DataFrame:
    """Each row once for every pair of blocks that its own is in."""
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return rows.select("*", other).withColumns({"p": F.least("block", "other"), "q": F.greatest("block", "other")})


def _blocks(docs, shingles, block_docs: int, block_shingles: int):
    return F.ceil(F.greatest(docs / block_docs, shingles / block_shingles)).cast("int")


def _region_links(spark: SparkSession, sets: DataFrame, kind: str, percent: int, block_docs: int, block_shingles: int) -> DataFrame:
    """Pairs (a, b) that join what the true links inside each region join; ``sets``: region, block, blocks, id, row, set."""
    alone = sets.withColumns({"part": F.lit(0).cast("long"), "p": F.col("block"), "q": F.col("block")})
    links = materialize(spark, _verified(alone, kind, percent), "links")
    large = sets.where("blocks > 1")
    nodes = materialize(spark, large.select("region", "id", "row", "blocks", (F.octet_length("set") / 8).cast("long").alias("n")).distinct(), "large")
    if nodes.isEmpty():
        return links
    several, before = links.join(nodes.select(F.col("id").alias("a")).distinct(), "a", "left_semi"), nodes.count()
    while True:
        found = connected_components(spark, several)
        grouped = nodes.join(found, nodes["id"] == found["node"], "left").withColumn("grp", F.coalesce("root", "id")).drop("node", "root")
        heads = grouped.groupBy("region", "grp").agg(F.min(F.struct("id", "row", "n")).alias("head"))
        heads = materialize(spark, heads.select("region", "grp", "head.*"), "heads")
        cuts = heads.groupBy("region").agg(F.count("*").alias("grps"), _blocks(F.count("*"), F.sum("n"), block_docs, block_shingles).alias("cut"))
        cuts = materialize(spark, cuts.where("grps > 1"), "cuts")
        now = cuts.agg(F.coalesce(F.sum("grps"), F.lit(0))).first()[0]
        if now == 0:
            return links
        if 2 * now > before:
            break
        before = now
        dealt = heads.join(cuts, "region").select("id", "row", F.expr("cast(pmod(xxhash64(id, row, grps), cut) as int)").alias("p"))
        met = large.join(dealt, ["id", "row"]).withColumns({"part": F.lit(0).cast("long"), "q": F.col("p"), "block": F.col("p")})
        more = materialize(spark, _verified(met, kind, percent), "links")
        links, several = links.unionByName(more), several.unionByName(more)

    # several groups are left: members meet on rare shingles, or block by block where that copies fewer sets
    still = grouped.join(cuts.select("region"), "region", "left_semi").select("id", "row", "grp")
    open_rows = materialize(spark, large.join(still, ["id", "row"]).dropDuplicates(["id", "row"]), "open")
    posts = materialize(spark, _prefixes(open_rows, kind, percent), "posts")
    lists = (posts.groupBy("region", "part").agg(F.min("grp").alias("low"), F.max("grp").alias("high"), F.count("*").alias("docs"),
                                                 _blocks(F.count("*"), F.sum("n"), block_docs, block_shingles).alias("blocks")).where("low <> high"))
    lists = materialize(spark, lists.select("region", "part", "docs", "blocks"), "lists")
    by_blocks = open_rows.groupBy("region").agg(F.sum("blocks").alias("copies"))
    by_lists = lists.groupBy("region").agg(F.sum(F.col("docs") * F.col("blocks")).alias("listed"))
    ways = materialize(spark, by_lists.join(by_blocks, "region").select("region", (F.col("listed") <= F.col("copies")).alias("rare")), "ways")
    place = F.expr("cast(pmod(xxhash64(id, row), blocks) as int)").alias("block")
    asked = (posts.join(lists, ["region", "part"]).join(ways.where("rare").select("region"), "region", "left_semi")
             .select("id", "row", "part", place, "blocks"))
    rare = _meet(open_rows.drop("block", "blocks").join(asked, ["id", "row"]))
    whole = _meet(open_rows.join(ways.where("not rare").select("region"), "region", "left_semi").withColumn("part", F.lit(0).cast("long")))
    whole = whole.where("p < q")  # each block has been linked by itself
    cols = [*_GROUP, "block", "id", "row", "set"]
    return links.unionByName(_verified(rare.select(*cols), kind, percent)).unionByName(_verified(whole.select(*cols), kind, percent))


def near_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                    percent: int = 75, block_docs: int = 128, block_shingles: int = 1 << 18, keyed: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (smallest id reachable), kept, and the row's ``text_key`` if ``keyed``.

    Two documents are linked if ``100 * |A & B| >= percent * |A | B|``.  ``block_docs`` and
    ``block_shingles`` bound what a verifying task holds.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sigs = materialize(spark, _signatures(src, k, kind), "signatures")
    stands = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "text_key")))  # the row that stands for a class
    classes = (sigs.where("set_key is not null").groupBy("set_key")
               .agg(stands.alias("row"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig")))
    classes = materialize(spark, classes.select("set_key", "row.id", F.col("row.text_key").alias("row"), "n", "sig"), "classes")

    # sketch agreement of a pair at similarity s: (1 + 3 s) / 4 of the values; 4.5 deviations below it
    s = (1 + 3 * percent / 100) / 4
    least = int(SIGNATURE * (s - 4.5 * (s * (1 - s) / SIGNATURE) ** 0.5))
    standing = classes.where("id is not null")
    pairs = candidate_pairs(spark, standing, kind, least)
    regions = connected_components(spark, pairs)
    members = regions.join(standing.select(F.col("id").alias("node"), "row", "n"), "node").select(
        "node", "row", F.col("root").alias("region"), "n")
    members = materialize(spark, members, "members")
    cuts = members.groupBy("region").agg(_blocks(F.count("*"), F.sum("n"), block_docs, block_shingles).alias("blocks"))
    placed = members.join(cuts, "region").select(
        "node", "row", "region", "blocks", F.expr("cast(pmod(xxhash64(node, row), blocks) as int)").alias("block"))
    keyed_src = src.where("id is not null").withColumn("text_key", text_key("text"))
    at = (keyed_src["id"] == placed["node"]) & (keyed_src["text_key"] == placed["row"])
    texts = keyed_src.join(placed.hint("shuffle_hash"), at).select("region", "block", "blocks", "id", "row", "text")
    links = _region_links(spark, materialize(spark, _sets(texts, kind, k), "sets"), kind, percent, block_docs, block_shingles)
    # rows that share an id are one document: its classes are linked
    named = sigs.where("set_key is not null and id is not null").select("id", "set_key")
    several = materialize(spark, named.groupBy("id").agg(F.count_distinct("set_key").alias("sets")).where("sets > 1"), "shared-ids")
    if not several.isEmpty():
        own = named.join(several.select("id"), "id", "left_semi").join(classes.select("set_key", F.col("id").alias("rep")), "set_key")
        links = links.unionByName(own.select(F.col("id").alias("a"), F.col("rep").alias("b")))
    found = connected_components(spark, links)

    rep = sigs.join(classes.select("set_key", F.col("id").alias("rep")), "set_key", "left")
    got = rep.join(found, rep["rep"] == found["node"], "left")
    component = F.when(F.col("set_key").isNull(), F.col("id")).otherwise(F.coalesce("root", "rep"))
    got = got.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), *["text_key"] * keyed)
    kept = F.col(id_col).eqNullSafe(F.col("component_id")).alias("kept")
    return got.select(id_col, "n_shingles", "component_id", kept, *["text_key"] * keyed)
