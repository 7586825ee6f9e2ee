"""Conversation prefix trie by time-forward processing.

Conversations that begin with the same turns share nodes of a trie.  A node is known by its depth and
a 128-bit key, the exclusive or of one hash for each (place, turn) on its path, so a parent's key is its
child's without the last hash, and keys of long conversations are put together from the keys of
their pieces: a conversation of any length is split over tasks.

*Shards.*  A node belongs to the smallest conversation that passes through it.  Ordered by (that
conversation, depth) nodes are cut into ranges, the shards, which keeps a conversation's nodes and mostly
those of its neighbours together, while one that holds a third of all nodes is still cut.  A shard's
nodes fall into components, the pieces of the trie that hang together inside it.

*Time-forward processing.*  Within a shard nodes come externally sorted by reverse level order (Spark's
spilling sort); a node takes the messages its children left for it in a priority queue, adds them up and
leaves its own total for its parent.  The queue keeps at most ``QUEUE`` messages in memory and the others
as sorted runs in the task's temporary file.  Across shards the same happens to the tree of components:
components that no other hangs on are added up by an aggregate over the nodes they hang on, the rest form a
smaller tree, which is processed in the same way (again in shards if it is larger than ``ONE_SHARD``), and
what hangs on a node from elsewhere is then a message that its shard starts with.

*Ends.*  The digest over the members that end at a node takes their ids in order: ids are range-partitioned,
joined into pieces of up to ``PIECE`` ids in the task, and the pieces of a node hashed one after another, a
piece at a time.

Defined cases: rows without conv_id belong to no conversation; a null role or text is empty; equal turns
are ordered by the digest of their role and text, and repeated rows are turns of their own; conversations
may turn out without turns, they are members of the root only; ids may be negative (the remainder takes their
sign); further columns are ignored; an empty table gives no row at all.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, ship_package

GROUP = 100
HEADS = 6
PIECE = 512
QUEUE = 200_000
ONE_SHARD = 100_000
#: Rows of output per Arrow batch of the passes.
OUT_ROWS = 10_000
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


# ------------------------------------------------------------------ running totals over long groups

def running(rows: DataFrame, order: list, name: str) -> DataFrame:
    """``rows`` (conv_id, xa, xb, ...) with ``no`` and ``ka``, ``kb``: place in the conversation by ``order``, from 1,
    and the exclusive or of ``xa`` (``xb``) up to there.

    Rows are range-partitioned down to the row, so a conversation may lie in several partitions; each is
    run through by itself, and what came before is added from the totals of the partitions' edges (at most
    two rows a partition).
    """
    spark = rows.sparkSession
    ship_package(spark)
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    kept = [c for c in rows.columns if c != "row"]
    ordered = rows.repartitionByRange("conv_id", *order, "row").sortWithinPartitions("conv_id", *order, "row")
    tagged = ordered.select(F.spark_partition_id().alias("part"), *kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, no, tops = None, 0, [0, 0]
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            conv = batch.column("conv_id").to_numpy()
            at = np.arange(n)
            begin = np.maximum.accumulate(np.where(np.concatenate([[True], conv[1:] != conv[:-1]]), at, 0))
            place = at - begin + 1
            first = begin == 0
            same = last is not None and conv[0] == last
            if same:
                place[first] += no
            keys = []
            for k, c in enumerate(("xa", "xb")):
                total = np.bitwise_xor.accumulate(batch.column(c).to_numpy())
                before = np.where(begin > 0, total[np.maximum(begin - 1, 0)], tops[k] if same else 0)
                keys.append(total ^ before)
            last, no, tops = conv[-1], int(place[-1]), [int(x[-1]) for x in keys]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place), pa.array(keys[0]), pa.array(keys[1])],
                                             [*batch.schema.names, "no", "ka", "kb"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tagged.schema.fields)
    local = materialize(tagged.mapInArrow(run, f"{fields}, no bigint, ka bigint, kb bigint"), name)
    edges = sorted(local.groupBy("part").agg(F.min("conv_id").alias("first"), F.max("conv_id").alias("last")).collect())
    cut = [(b["first"],) for a, b in zip(edges, edges[1:]) if a["last"] == b["first"]]
    if not cut:
        return local.drop("part")
    ids = spark.createDataFrame(sorted(set(cut)), "conv_id bigint")
    ends = (local.join(F.broadcast(ids), "conv_id", "left_semi").groupBy("part", "conv_id")
            .agg(F.max(F.struct("no", "ka", "kb")).alias("e")).collect())
    offsets, sums = [], {}
    for r in sorted(ends, key=lambda r: r["part"]):
        n, a, b = sums.get(r["conv_id"], (0, 0, 0))
        if n:
            offsets.append((r["part"], r["conv_id"], n, a, b))
        sums[r["conv_id"]] = (n + r["e"]["no"], a ^ r["e"]["ka"], b ^ r["e"]["kb"])
    before = F.broadcast(spark.createDataFrame(offsets, "part int, conv_id bigint, n0 bigint, a0 bigint, b0 bigint"))
    zero = F.lit(0).cast("bigint")
    return local.join(before, ["part", "conv_id"], "left").select(
        *kept, (F.col("no") + F.coalesce("n0", zero)).alias("no"), F.col("ka").bitwiseXOR(F.coalesce("a0", zero)).alias("ka"),
        F.col("kb").bitwiseXOR(F.coalesce("b0", zero)).alias("kb"))


# ------------------------------------------------------------------ rebuilt conversations

def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) after rebuilding: (conv_id, depth, digest, chars, ends) and (conv_id, turns).

    Texts are read once and never shuffled: a turn is the digest of its role and text from here on.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    zero = F.lit(0).cast("bigint")
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", digest.alias("digest"), F.length(text).cast("bigint").alias("chars"),
        zero.alias("xa"), zero.alias("xb"))
    turns = materialize(turns, "trie-turns")
    original = running(turns, [F.col("turn").asc_nulls_first(), "digest"], "trie-numbered").select("conv_id", "no", "digest", "chars")
    convs = original.groupBy("conv_id").agg(F.max("no").alias("n"))
    convs = materialize(convs.select("conv_id", "n", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("h"),
                                     (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base")), "trie-conversations")
    bases = convs.filter(F.col("conv_id") == F.col("base")).select(F.col("base").alias("b"), F.col("n").alias("b_n"))
    convs = convs.join(bases, F.col("base") == F.col("b"), "left")
    taken = F.least("h", F.coalesce("b_n", zero))
    convs = materialize(convs.select("conv_id", "base", "h", taken.alias("taken"),
                                     (taken + F.greatest(F.col("n") - F.col("h"), zero)).alias("turns")), "trie-lengths")
    # A base lends at most HEADS - 1 turns to at most 2 * GROUP conversations.
    heads = original.filter((F.col("no") < HEADS) & (F.col("conv_id") % GROUP == 0)).select(
        F.col("conv_id").alias("b"), "no", "digest", "chars")
    lent = convs.join(heads, (F.col("base") == F.col("b")) & (F.col("no") <= F.col("h"))).select(
        "conv_id", F.col("no").alias("depth"), "digest", "chars", (F.col("no") == F.col("turns")).alias("ends"))
    depth = F.col("no") - F.col("h") + F.col("taken")
    # Both sides are written, so that the adaptive skew join splits a conversation of very many turns.
    own = original.join(convs.withColumnRenamed("conv_id", "c"), (F.col("conv_id") == F.col("c")) & (F.col("no") > F.col("h"))).select(
        "conv_id", depth.alias("depth"), "digest", "chars", (depth == F.col("turns")).alias("ends"))
    return lent.unionByName(own), convs.select("conv_id", "turns")


# ------------------------------------------------------------------ messages

class SpillingQueue:
    """A priority queue of equally long tuples of 64-bit integers, smallest first.

    At most ``limit`` items stay in memory; when they are more, all are written as one sorted run to a
    temporary file of this process, gone when it is closed, and read back a little at a time.
    """

    READ = 1024

    def __init__(self, width: int, limit: int = QUEUE):
        self.form = struct.Struct(f"<{width}q")
        self.limit = limit
        self.heap: list[tuple] = []
        self.runs: list[tuple] = []  # heap of (head, number of run, rest of the block)
        self.files: dict[int, tuple] = {}
        self.made = 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            file = tempfile.TemporaryFile()
            self.heap.sort()
            for x in self.heap:
                file.write(self.form.pack(*x))
            file.seek(0)
            self.heap = []
            self.made += 1
            self.files[self.made] = file
            self._refill(self.made)

    def _refill(self, run: int) -> None:
        data = self.files[run].read(self.form.size * self.READ)
        if not data:
            self.files.pop(run).close()
            return
        block = self.form.iter_unpack(data)
        heapq.heappush(self.runs, (next(block), run, block))

    def peek(self) -> tuple | None:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            return self.runs[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            head, run, block = heapq.heappop(self.runs)
            following = next(block, None)
            if following is not None:
                heapq.heappush(self.runs, (following, run, block))
            else:
                self._refill(run)
            return head
        return heapq.heappop(self.heap)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _arrow(rows: Iterator[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    block: list[tuple] = []
    for r in rows:
        block.append(r)
        if len(block) == OUT_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*block)], names)
            block = []
    if block:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*block)], names)


#: A tree: its nodes' keys, their parents' keys (null: none), the order of shards, and what is summed.
KEY, PARENT, VALUES = ["d", "ka", "kb"], ["pd", "pa", "pb"], ["leaves", "saved"]


def inside() -> Column:
    """Is the node's parent in its own shard."""
    return F.coalesce(F.col("pshard") == F.col("shard"), F.lit(False))


def upwards(rows: DataFrame) -> DataFrame:
    """(d, ka, kb, leaves, saved) summed over the part of each node's subtree inside its shard.

    Reverse level order: a child is deeper than its parent, so all messages for a node wait when it comes.
    """
    names = [*KEY, *VALUES]
    ordered = rows.select("shard", *KEY, *PARENT, inside().alias("inside"), *VALUES).repartition("shard").sortWithinPartitions(
        "shard", F.col("d").desc(), "ka", "kb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def totals() -> Iterator[tuple]:
            queue, now = SpillingQueue(5), None
            for shard, d, ka, kb, pd, pa_, pb, inside, leaves, saved in _rows(batches):
                if shard != now:
                    queue, now = SpillingQueue(5), shard
                me = (-d, ka, kb)
                while (m := queue.peek()) is not None and m[:3] == me:
                    queue.pop()
                    leaves += m[3]
                    saved += m[4]
                if inside:
                    queue.push((-pd, pa_, pb, leaves, saved))
                yield d, ka, kb, leaves, saved

        return _arrow(totals(), names)

    return ordered.mapInArrow(run, ", ".join(f"{c} bigint" for c in names))


def downwards(rows: DataFrame) -> DataFrame:
    """(d, ka, kb, cd, ca, cb): each node with the topmost node of its component.

    Level order by the parents: a node leaves one message for its children, which come one after another.
    """
    names = [*KEY, "cd", "ca", "cb"]
    first = F.when(inside(), F.col("pd")).otherwise(F.lit(-1).cast("bigint"))
    ordered = rows.select("shard", *KEY, first.alias("first"), "pa", "pb").repartition("shard").sortWithinPartitions(
        "shard", "first", "pa", "pb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def components() -> Iterator[tuple]:
            queue, now = SpillingQueue(6), None
            for shard, d, ka, kb, pd, pa_, pb in _rows(batches):
                if shard != now:
                    queue, now = SpillingQueue(6), shard
                top = (d, ka, kb)
                if pd >= 0:
                    parent = (pd, pa_, pb)
                    while (m := queue.peek())[:3] < parent:
                        queue.pop()
                    top = m[3:]
                queue.push((d, ka, kb, *top))
                yield d, ka, kb, *top

        return _arrow(components(), names)

    return ordered.mapInArrow(run, ", ".join(f"{c} bigint" for c in names))


def _named(df: DataFrame, **names: str) -> DataFrame:
    return df.select(*[F.col(old).alias(new) for new, old in names.items()])


def _on(a: list[str], b: list[str]):
    return reduce(lambda x, y: x & y, [F.col(p) == F.col(q) for p, q in zip(a, b)])


def sharded(tree: DataFrame, name: str) -> DataFrame:
    """``tree`` (d, ka, kb, pd, pa, pb, owner, leaves, saved) with ``shard`` and the parent's, ``pshard``, written."""
    cut = tree.repartitionByRange("owner", "d", "ka") if tree.count() > ONE_SHARD else tree.coalesce(1)
    cut = materialize(cut.withColumn("shard", F.spark_partition_id()), f"{name}-ranges")
    places = _named(cut, qd="d", qa="ka", qb="kb", pshard="shard")
    # Read from files on both sides: a parent of very many children is split by the adaptive skew join.
    return materialize(cut.join(places, _on(PARENT, ["qd", "qa", "qb"]), "left").drop("qd", "qa", "qb"), name)


def subtree_totals(tree: DataFrame, name: str = "trie-tree") -> DataFrame:
    """(d, ka, kb, leaves, saved) summed over the whole subtree of each node of a forest."""
    rows = sharded(tree, name)
    crossing = rows.filter(F.col("pshard") != F.col("shard"))
    if crossing.isEmpty():
        return upwards(rows)
    top, held = ["cd", "ca", "cb"], ["hd", "ha", "hb"]
    nodes = materialize(downwards(rows), f"{name}-components")
    sums = (nodes.join(_named(rows, hd="d", ha="ka", hb="kb", leaves="leaves", saved="saved"), _on(KEY, held))
            .groupBy(*top).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
    # A component hangs on a node (its top's parent) of another component.
    links = materialize(_named(crossing, hd="pd", ha="pa", hb="pb", td="d", ta="ka", tb="kb"), f"{name}-links")
    carriers = nodes.join(links.select(*held).distinct(), _on(KEY, held)).select(*held, *top)
    carriers = materialize(carriers, f"{name}-carriers")
    inner = carriers.select(*top).distinct()
    parts = sums.join(_named(rows, hd="d", ha="ka", hb="kb", owner="owner"), _on(top, held)).drop(*held)
    parts = materialize(parts.join(_named(inner, id="cd", ia="ca", ib="cb"), _on(top, ["id", "ia", "ib"]), "left")
                        .select(*top, "owner", *VALUES, F.col("id").isNotNull().alias("inner")), f"{name}-parts")
    ends = ["td", "ta", "tb"]
    outer = (links.join(parts.filter(~F.col("inner")), _on(ends, top)).groupBy(*held)
             .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
    outer = materialize(outer, f"{name}-outer")
    # The smaller tree: components that others hang on, with what hangs on them and carries nothing itself.
    on_it = outer.join(_named(carriers, gd="hd", ga="ha", gb="hb", cd="cd", ca="ca", cb="cb"), _on(held, ["gd", "ga", "gb"]))
    on_it = on_it.groupBy(*top).agg(F.sum("leaves").alias("l2"), F.sum("saved").alias("s2"))
    above = links.join(_named(carriers, gd="hd", ga="ha", gb="hb", pd="cd", pa="ca", pb="cb"), _on(held, ["gd", "ga", "gb"])).select(*ends, *PARENT)
    zero = F.lit(0).cast("bigint")
    smaller = (parts.filter("inner").join(on_it, top, "left").join(above, _on(top, ends), "left")
               .select(F.col("cd").alias("d"), F.col("ca").alias("ka"), F.col("cb").alias("kb"), *PARENT, "owner",
                       (F.col("leaves") + F.coalesce("l2", zero)).alias("leaves"), (F.col("saved") + F.coalesce("s2", zero)).alias("saved")))
    whole = subtree_totals(materialize(smaller, f"{name}-smaller"), f"{name}-up")
    through = links.join(whole, _on(ends, KEY)).groupBy(*held).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    waiting = outer.unionByName(through).groupBy(*held).agg(F.sum("leaves").alias("l2"), F.sum("saved").alias("s2"))
    full = rows.join(waiting, _on(KEY, held), "left").withColumns(
        {"leaves": F.col("leaves") + F.coalesce("l2", zero), "saved": F.col("saved") + F.coalesce("s2", zero)})
    return upwards(full.drop("l2", "s2", *held))


# ------------------------------------------------------------------ ends

def end_digests(ends: DataFrame) -> DataFrame:
    """(d, ka, kb, sha) over the ids of ``ends`` (d, ka, kb, conv_id), ascending, comma-joined."""
    ship_package(ends.sparkSession)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*KEY, "first", "ids"]

        def emit(out: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*out))
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string())], names)

        key, ids, out = None, [], []
        for d, ka, kb, conv in _rows(batches):
            if (d, ka, kb) != key or len(ids) == PIECE:
                if ids:
                    out.append((*key, ids[0], ",".join(map(str, ids))))
                    if len(out) == 1000:
                        yield emit(out)
                        out = []
                key, ids = (d, ka, kb), []
            ids.append(conv)
        if ids:
            out.append((*key, ids[0], ",".join(map(str, ids))))
        if out:
            yield emit(out)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*KEY, "sha"]

        def emit(out: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*out))
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())], names)

        key, sha, out = None, None, []
        for d, ka, kb, _, ids in _rows(batches):
            if (d, ka, kb) != key:
                if key is not None:
                    out.append((*key, sha.hexdigest()))
                    if len(out) == OUT_ROWS:
                        yield emit(out)
                        out = []
                key, sha = (d, ka, kb), hashlib.sha256(ids.encode())
            else:
                sha.update(f",{ids}".encode())
        if key is not None:
            out.append((*key, sha.hexdigest()))
        if out:
            yield emit(out)

    kinds = "d bigint, ka bigint, kb bigint"
    # Ranges of ids: the pieces of a node from different tasks do not overlap.
    cut = ends.select(*KEY, "conv_id").repartitionByRange("conv_id").sortWithinPartitions(*KEY, "conv_id")
    cut = cut.mapInArrow(pieces, f"{kinds}, first bigint, ids string")
    return cut.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(hashes, f"{kinds}, sha string")


# ------------------------------------------------------------------ the trie

def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for each node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    spark = conversations.sparkSession
    ship_package(spark)
    turns, convs = rebuilt(conversations)
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    turns = turns.select("conv_id", "depth", "chars", "ends", F.xxhash64(F.lit(1), "depth", "digest").alias("xa"),
                         F.xxhash64(F.lit(2), "depth", "digest").alias("xb"))
    turns = materialize(turns, "trie-rebuilt")
    keyed = running(turns, ["depth"], "trie-keyed").select(
        F.col("depth").cast("bigint").alias("d"), "ka", "kb", F.col("ka").bitwiseXOR(F.col("xa")).alias("pa"),
        F.col("kb").bitwiseXOR(F.col("xb")).alias("pb"), "conv_id", "chars", "ends")
    nodes = keyed.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("owner"), F.first("pa").alias("pa"),
                                    F.first("pb").alias("pb"), F.max("chars").alias("chars"))
    nodes = materialize(nodes.withColumn("pd", F.col("d") - 1), "trie-nodes")
    # Children by their parents' keys; one row a key on both sides of the join.
    children = nodes.groupBy(*PARENT).agg(F.count(F.lit(1)).alias("n_children")).withColumnsRenamed({"pd": "qd", "pa": "qa", "pb": "qb"})
    nodes = nodes.join(children, _on(KEY, ["qd", "qa", "qb"]), "left").drop("qd", "qa", "qb").withColumn("n_children", F.coalesce("n_children", zero))
    nodes = materialize(nodes.withColumns({"leaves": F.when(F.col("n_children") == 0, one).otherwise(zero),
                                           "saved": (F.col("n_convs") - 1) * F.col("chars")}), "trie-counted")
    no = F.lit(None).cast("bigint")
    tree = nodes.select(*KEY, *[F.when(F.col("d") > 1, F.col(c)).otherwise(no).alias(c) for c in PARENT], "owner", *VALUES)
    totals = materialize(_named(subtree_totals(tree), hd="d", ha="ka", hb="kb", n_leaves="leaves", saved_tokens="saved"), "trie-totals")
    everyone = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("owner"))
    ends = keyed.filter("ends").select(*KEY, "conv_id").unionByName(
        convs.filter(F.col("turns") == 0).select(zero.alias("d"), zero.alias("ka"), zero.alias("kb"), "conv_id"))
    digests = materialize(_named(end_digests(ends), ed="d", ea="ka", eb="kb", sha="sha"), "trie-ends")

    parents = _named(nodes, qd="d", qa="ka", qb="kb", parent_conv_id="owner")
    below = nodes.join(parents, _on(PARENT, ["qd", "qa", "qb"]), "left").drop("qd", "qa", "qb")
    below = below.join(totals, _on(KEY, ["hd", "ha", "hb"])).join(digests, _on(KEY, ["ed", "ea", "eb"]), "left")
    root_id = everyone.select("owner").scalar()
    below = below.select(F.col("owner").alias("conv_id"), F.col("d").alias("depth"),
                         F.when(F.col("d") == 1, root_id).otherwise(F.col("parent_conv_id")).alias("parent_conv_id"),
                         "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", F.lit(EMPTY_SHA)).alias("ends_sha256"))
    # The root: sums over all nodes.
    over = nodes.agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.count_if(F.col("d") == 1).alias("tops"))
    root = everyone.filter("n > 0").select(
        F.col("owner").alias("conv_id"), zero.alias("depth"), no.alias("parent_conv_id"), F.col("n").alias("n_convs"),
        over.select("tops").scalar().alias("n_children"), F.coalesce(over.select("leaves").scalar(), one).alias("n_leaves"),
        F.coalesce(over.select("saved").scalar(), zero).alias("saved_tokens"),
        F.coalesce(digests.filter("ed = 0").select("sha").scalar(), F.lit(EMPTY_SHA)).alias("ends_sha256"))
    return below.unionByName(root)


#: The same in DuckDB, over lists of whole turns.  crc32 is folded bit by bit over the decimal digits.
ORACLE_TRIE = """
WITH RECURSIVE original AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS no
  FROM conversations WHERE conv_id IS NOT NULL
),
bits(conv_id, rest, step, crc) AS (
  SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR), 8, CAST(4294967295 AS BIGINT) FROM original
  UNION ALL
  SELECT conv_id, CASE WHEN step = 8 THEN rest[2:] ELSE rest END, CASE WHEN step = 8 THEN 0 ELSE step + 1 END,
         CASE WHEN step = 8 THEN xor(crc, CAST(ord(rest[1]) AS BIGINT))
              WHEN crc % 2 = 1 THEN xor(crc // 2, CAST(3988292384 AS BIGINT)) ELSE crc // 2 END
  FROM bits WHERE step < 8 OR rest <> ''
),
heads AS (SELECT conv_id, xor(crc, CAST(4294967295 AS BIGINT)) % 6 AS h FROM bits WHERE step = 8 AND rest = ''),
rebuilt AS (
  SELECT h.conv_id, 0 AS half, o.no, o.role, o.text FROM heads h JOIN original o ON o.conv_id = h.conv_id - h.conv_id % 100 AND o.no <= h.h
  UNION ALL
  SELECT h.conv_id, 1, o.no, o.role, o.text FROM heads h JOIN original o ON o.conv_id = h.conv_id AND o.no > h.h
),
whole AS (
  SELECT h.conv_id, coalesce(list({'role': r.role, 'text': r.text} ORDER BY r.half, r.no) FILTER (WHERE r.no IS NOT NULL), []) AS path
  FROM heads h LEFT JOIN rebuilt r ON r.conv_id = h.conv_id GROUP BY h.conv_id
),
passes AS (SELECT conv_id, path[:d] AS prefix, d, len(path) = d AS ends FROM whole, unnest(range(0, len(path) + 1)) AS t(d)),
nodes AS (
  SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * coalesce(length(prefix[d].text), 0) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM passes GROUP BY prefix, d
),
counted AS (SELECT n.prefix, count(c.prefix) AS n_children FROM nodes n LEFT JOIN nodes c ON c.d = n.d + 1 AND c.prefix[:n.d] = n.prefix GROUP BY n.prefix)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, min(p.conv_id) AS parent_conv_id, n.n_convs, k.n_children,
       CAST(count(*) FILTER (WHERE ck.n_children = 0) AS BIGINT) AS n_leaves, CAST(sum(c.saved) AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN counted k ON k.prefix = n.prefix
JOIN nodes c ON c.d >= n.d AND c.prefix[:n.d] = n.prefix JOIN counted ck ON ck.prefix = c.prefix
LEFT JOIN nodes p ON n.d > 0 AND p.d = n.d - 1 AND p.prefix = n.prefix[:n.d - 1]
GROUP BY n.prefix, n.d, n.conv_id, n.n_convs, k.n_children, n.ends_sha256
"""
