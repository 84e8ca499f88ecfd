"""Operator 13: prefix trie of rebuilt conversations, totals by time-forward processing.

1. Turns are numbered per conversation (blocks of turn values first, offsets
   after, so a very long conversation spreads), texts left behind: a turn
   becomes two 64-bit hashes of role and text, and its text's bytes.
2. Conversation c is rebuilt from the first h turns of conversation c - c % 5
   and its own turns after the first h, h = crc32(c) % 9.
3. A node (depth, key) is the running XOR, over 2 x 64 bits, of hashes of
   (position, turn); long conversations run in blocks and add the blocks before.
   Nodes are counted by one partially aggregated group-by.
4. Shards. ``weight`` counts the turns at and below a node. A node over the
   shard bound belongs to the crown (at most 4,096 nodes a level); the subtrees
   that hang below the crown are shards of bounded size, so a first turn that a
   third of all conversations share is divided further down.
5. Time-forward processing. A shard's nodes are sorted in reverse level order
   (Spark's external sort); a node takes the messages addressed to it off a
   priority queue, adds its own figures and sends the totals to its parent. The
   queue spills sorted runs and merges them. Totals of shard roots are summed
   per parent and go through the crown in the same way.
6. Ids of conversations that end at a node are sorted by range over tasks into
   chunks of text; one digest per node runs over its chunks.

Edge cases: null role or text is empty; null turns come first; rows of one
conversation with equal turns are ordered by role and text, and repeated rows
are turns of their own; rows without conv_id belong to no conversation and are
left out; a conversation whose rebuilt form has no turn is a member of the root;
an empty table gives no nodes, other columns are ignored. The crown of a
conversation with very many turns is one path, handled as a stream by one task.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import written

#: Turns at and below the root of a shard; the bound grows with the table so that a level of the crown has at most CROWN nodes.
SHARD_TURNS, CROWN = 1 << 16, 4_096
#: Messages that a queue holds in memory.
MESSAGES = 1 << 16
#: Turns of one conversation that are numbered and hashed together.
BLOCK = 1 << 12
FAMILY, MOST_SHARED = 5, 9


# ---------------------------------------------------------------- conversations

def _numbered(conversations: DataFrame, block: int) -> DataFrame:
    """conv_id, p (1-based place in the conversation), c1, c2 (hashes of role and text), size."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select("conv_id", "turn", role.alias("role"), text.alias("text"))
    # texts are carried only where two rows of a conversation have the same turn
    ties = written(rows.groupBy("conv_id", "turn").agg(F.count("*").alias("n")).where("n > 1").select(
        F.col("conv_id").alias("tie_id"), F.col("turn").alias("tie_turn")), "trie-ties")
    tied = rows.join(ties, (F.col("conv_id") == F.col("tie_id")) & F.col("turn").eqNullSafe(F.col("tie_turn")), "left")
    hashed = tied.select("conv_id", "turn", "role", F.when(F.col("tie_id").isNotNull(), F.col("text")).alias("tie"),
                         F.xxhash64("role", "text").alias("c1"), F.xxhash64(F.lit("second"), "text", "role").alias("c2"),
                         F.octet_length("text").cast("long").alias("size"),
                         F.floor(F.col("turn") / block).alias("block"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("tie")]
    placed = written(hashed.withColumn("p", F.row_number().over(Window.partitionBy("conv_id", "block").orderBy(*order)).cast("long"))
                     .select("conv_id", "block", "p", "c1", "c2", "size"), "trie-placed")
    blocks = placed.groupBy("conv_id", "block").agg(F.max("p").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy(F.col("block").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1))
    offsets = written(blocks.select(F.col("conv_id").alias("o_id"), F.col("block").alias("o_block"), before.alias("before")).where("before IS NOT NULL"), "trie-offsets")
    same = (F.col("conv_id") == F.col("o_id")) & F.col("block").eqNullSafe(F.col("o_block"))
    return placed.join(offsets, same, "left").select("conv_id", (F.col("p") + F.coalesce("before", F.lit(0))).alias("p"), "c1", "c2", "size")


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, len) of every conversation, and its turns (conv_id, pos, c1, c2, size, len)."""
    own = turns.groupBy("conv_id").agg(F.max("p").alias("own"))
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED
    convs = own.select("conv_id", "own", shared.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("donor"))
    donors = own.select(F.col("conv_id").alias("donor_id"), F.col("own").alias("donor_own"))
    head = F.least("h", F.coalesce("donor_own", F.lit(0)))
    convs = convs.join(donors, F.col("donor") == F.col("donor_id"), "left").select(
        F.col("conv_id").alias("c"), "h", "donor", head.alias("head"), (head + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("len"))
    convs = written(convs, "trie-conversations")
    from_donor = turns.where(F.col("p") < MOST_SHARED).join(convs.where("h > 0"), F.col("conv_id") == F.col("donor")).where("p <= h")
    from_own = turns.join(convs, F.col("conv_id") == F.col("c")).where("p > h")
    columns = ["c1", "c2", "size", "len"]
    rows = from_donor.select(F.col("c").alias("conv_id"), F.col("p").alias("pos"), *columns).unionByName(
        from_own.select("conv_id", (F.col("head") + F.col("p") - F.col("h")).alias("pos"), *columns))
    return convs.select(F.col("c").alias("conv_id"), "len"), rows


def _paths(convs: DataFrame, rows: DataFrame, block: int) -> DataFrame:
    """conv_id, depth, k1, k2, p1, p2 (the parent's key), size, len: every node on every conversation's path."""
    hashed = rows.select("conv_id", "pos", F.xxhash64("pos", "c1", "c2").alias("h1"), F.xxhash64("c2", "pos", "c1").alias("h2"), "size", "len",
                         F.floor((F.col("pos") - 1) / block).alias("block"))
    running = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = hashed.select("*", *(F.bit_xor(f"h{i}").over(running).alias(f"x{i}") for i in (1, 2)))
    totals = hashed.where(F.col("len") > block).groupBy("conv_id", "block").agg(F.bit_xor("h1").alias("t1"), F.bit_xor("h2").alias("t2"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(totals.select(F.col("conv_id").alias("o_id"), F.col("block").alias("o_block"),
                                    *(F.bit_xor(f"t{i}").over(earlier).alias(f"o{i}") for i in (1, 2))).where("o1 IS NOT NULL"), "trie-blocks")
    found = local.join(offsets, (F.col("conv_id") == F.col("o_id")) & (F.col("block") == F.col("o_block")), "left")
    key = [F.col(f"x{i}").bitwiseXOR(F.coalesce(f"o{i}", F.lit(0))) for i in (1, 2)]
    deep = found.select("conv_id", F.col("pos").alias("depth"), key[0].alias("k1"), key[1].alias("k2"),
                        key[0].bitwiseXOR(F.col("h1")).alias("p1"), key[1].bitwiseXOR(F.col("h2")).alias("p2"), "size", "len")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    top = convs.select("conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), none.alias("p1"), none.alias("p2"), zero.alias("size"), "len")
    return deep.unionByName(top)


# ---------------------------------------------------------------- time-forward processing

class SpillingQueue:
    """A priority queue of tuples that keeps ``limit`` of them in memory.

    What is over goes, sorted, to an unnamed file of the task (in the folders
    Spark spills to), which is read back as a stream; nothing outlives the task.
    """

    def __init__(self, limit: int):
        self.limit, self.heap, self.runs, self.spilled = limit, [], [], 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
        file = tempfile.TemporaryFile(dir=folder if os.path.isdir(folder) else None)
        self.heap.sort()
        for i in range(0, len(self.heap), 4096):
            pickle.dump(self.heap[i : i + 4096], file)
        self.heap = []
        file.seek(0)
        run = self._stream(file)
        self.spilled += 1
        heapq.heappush(self.runs, (next(run), self.spilled, run))

    @staticmethod
    def _stream(file) -> Iterator[tuple]:
        while True:
            try:
                part = pickle.load(file)
            except EOFError:
                file.close()
                return
            yield from part

    def peek(self) -> tuple | None:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            return self.runs[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            first, number, run = self.runs[0]
            following = next(run, None)
            if following is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (following, number, run))
            return first
        return heapq.heappop(self.heap)


_KEPT = ["conv_id", "depth", "k1", "k2", "p1", "p2", "n_convs", "n_ends", "end_id"]
_NODE = "shard_depth long, s1 long, s2 long, " + ", ".join(f"{c} long" for c in _KEPT) + ", own long, children long, leaves long, saved long"
_TOTALS = ", ".join(f"{c} long" for c in _KEPT) + ", n_children long, n_leaves long, saved_tokens long, is_root boolean"


def _forward(limit: int):
    """Nodes sorted by (shard, depth descending, key) -> nodes with the totals of their subtrees.

    Columns children, leaves and saved hold what came from outside the shard.
    """
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, shard = SpillingQueue(limit), None
        for batch in batches:
            col = {n: batch.column(n).to_pylist() for n in ("shard_depth", "s1", "s2", "depth", "k1", "k2", "p1", "p2", "own", "children", "leaves", "saved")}
            out: list[list] = [[], [], [], []]
            for s0, s1, s2, depth, k1, k2, p1, p2, own, children, leaves, saved in zip(*col.values()):
                if (s0, s1, s2) != shard:
                    queue, shard = SpillingQueue(limit), (s0, s1, s2)
                while (m := queue.peek()) is not None and m[0] == -depth and m[1] == k1 and m[2] == k2:
                    queue.pop()
                    children += 1
                    leaves += m[3]
                    saved += m[4]
                saved += own
                leaves += not children
                root = depth == s0
                if not root:
                    queue.push((1 - depth, p1, p2, leaves, saved))
                for values, v in zip(out, (children, leaves, saved, root)):
                    values.append(v)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in _KEPT), *(pa.array(v, pa.int64()) for v in out[:3]), pa.array(out[3], pa.bool_())],
                                             [*_KEPT, "n_children", "n_leaves", "saved_tokens", "is_root"])
    return emit


def _totals(paths: DataFrame, nodes: DataFrame, shard_turns: int, messages: int) -> DataFrame:
    bound = max(shard_turns, -(-(nodes.agg(F.max("weight")).first()[0] or 0) // CROWN))
    key = ["depth", "k1", "k2"]
    crown = nodes.where(F.col("weight") > bound)
    names = written(crown.select(*(F.col(c).alias(f"c_{c}") for c in key)), "trie-crown")
    zero = F.lit(0).cast("long")
    outside = [zero.alias(c) for c in ("children", "leaves", "saved")]
    columns = [*_KEPT, "own"]
    if names.isEmpty():
        light = nodes.select(zero.alias("shard_depth"), zero.alias("s1"), zero.alias("s2"), *columns, *outside)
    else:
        # the crown holds the upper part of every path; the next node down heads a shard
        met = paths.join(names, (F.col("depth") == F.col("c_depth")) & (F.col("k1") == F.col("c_k1")) & (F.col("k2") == F.col("c_k2")), "left_semi")
        cut = met.groupBy("conv_id").agg((F.max("depth") + 1).alias("cut")).withColumnRenamed("conv_id", "cut_id")
        heads = paths.join(cut, (F.col("conv_id") == F.col("cut_id")) & (F.col("depth") == F.col("cut")))
        heads = heads.select(F.col("conv_id").alias("head_id"), F.col("depth").alias("shard_depth"), F.col("k1").alias("s1"), F.col("k2").alias("s2"))
        light = nodes.where(F.col("weight") <= bound).join(heads, F.col("conv_id") == F.col("head_id")).select("shard_depth", "s1", "s2", *columns, *outside)

    def passed(rows: DataFrame) -> DataFrame:
        order = ["shard_depth", "s1", "s2", F.col("depth").desc(), "k1", "k2"]
        return rows.repartition("shard_depth", "s1", "s2").sortWithinPartitions(*order).mapInArrow(_forward(messages), _TOTALS)

    below = written(passed(light), "trie-shards")
    if names.isEmpty():
        return below
    sent = below.where("is_root").groupBy((F.col("depth") - 1).alias("m_depth"), F.col("p1").alias("m1"), F.col("p2").alias("m2")).agg(
        F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    got = crown.join(sent, (F.col("depth") == F.col("m_depth")) & (F.col("k1") == F.col("m1")) & (F.col("k2") == F.col("m2")), "left")
    top = got.select(zero.alias("shard_depth"), zero.alias("s1"), zero.alias("s2"), *columns, *(F.coalesce(c, zero).alias(c) for c in ("children", "leaves", "saved")))
    return below.unionByName(passed(top))


# ---------------------------------------------------------------- digests of ending conversations

def _chunks(size: int):
    """Sorted (k1, k2, depth, conv_id) -> comma-joined ids in chunks of about ``size`` bytes."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            k1, k2, depth, ids = (batch.column(c).to_numpy() for c in ("k1", "k2", "depth", "conv_id"))
            new = np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (depth[1:] != depth[:-1])])
            at = np.flatnonzero(new)
            step = max(1, size // 20)
            starts = np.concatenate([np.arange(a, b, step) for a, b in zip(at, np.append(at[1:], len(ids)))])
            text = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(starts, np.append(starts[1:], len(ids)))]
            yield pa.RecordBatch.from_arrays([pa.array(x[starts]) for x in (k1, k2, depth, ids)] + [pa.array(text)], ["e1", "e2", "e_depth", "first", "ids"])
    return emit


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks -> SHA-256 of each node's ids."""
    last, running = None, None
    names = ["e1", "e2", "e_depth", "sha"]

    def row(node, digest) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in node), pa.array([digest])], names)

    for batch in batches:
        done: list[tuple] = []
        for *node, ids in zip(*(batch.column(c).to_pylist() for c in ("e1", "e2", "e_depth", "ids"))):
            if node == last:
                running.update(b",")
            else:
                if last is not None:
                    done.append((*last, running.hexdigest()))
                last, running = node, hashlib.sha256()
            running.update(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names)
    if last is not None:
        yield row(last, running.hexdigest())


def _ends(paths: DataFrame, chunk: int) -> DataFrame:
    """e1, e2, e_depth, sha of the nodes where more than one conversation ends."""
    ends = paths.where("depth = len").select("k1", "k2", "depth", "conv_id")
    place = ["k1", "k2", "depth", "conv_id"]
    chunks = ends.repartitionByRange(*place).sortWithinPartitions(*place).mapInArrow(_chunks(chunk), "e1 long, e2 long, e_depth long, first long, ids string")
    node = ["e1", "e2", "e_depth"]
    return chunks.repartition(*node).sortWithinPartitions(*node, "first").mapInArrow(_digests, "e1 long, e2 long, e_depth long, sha string")


# ---------------------------------------------------------------- operator

def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS, messages: int = MESSAGES, block: int = BLOCK, chunk: int = 1 << 16) -> DataFrame:
    """conversations (conv_id, turn, role, text) -> one row per node: conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns = written(_numbered(conversations, block), "trie-turns")
    paths = written(_paths(*_rebuilt(turns), block), "trie-paths")
    ending = F.col("depth") == F.col("len")
    nodes = paths.groupBy("depth", "k1", "k2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
        ((F.count("*") - 1) * F.max("size")).alias("own"), F.sum(F.col("len") - F.col("depth") + 1).alias("weight"),
        F.count_if(ending).alias("n_ends"), F.min(F.when(ending, F.col("conv_id"))).alias("end_id"))
    nodes = written(nodes, "trie-nodes")
    totals = _totals(paths, nodes, shard_turns, messages)
    sha = _ends(paths, chunk)
    several = totals.where("n_ends > 1").join(sha, (F.col("k1") == F.col("e1")) & (F.col("k2") == F.col("e2")) & (F.col("depth") == F.col("e_depth")), "left")
    alone = totals.where("n_ends <= 1").withColumn("sha", F.sha2(F.coalesce(F.col("end_id").cast("string"), F.lit("")).cast("binary"), 256))
    kept = [*_KEPT, "n_children", "n_leaves", "saved_tokens", "sha"]
    rows = several.select(*kept).unionByName(alone.select(*kept))
    parents = nodes.select((F.col("depth") + 1).alias("d"), F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    joined = rows.join(parents, (F.col("depth") == F.col("d")) & (F.col("p1") == F.col("q1")) & (F.col("p2") == F.col("q2")), "left")
    return joined.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.col("sha").alias("ends_sha256"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))


ORACLE_SQL = """
WITH RECURSIVE placed AS (
  SELECT conv_id, {'r': coalesce(role, ''), 't': coalesce(text, '')} AS said,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(said ORDER BY p) AS turns FROM placed GROUP BY conv_id),
crc AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR) AS digits, 0 AS k, CAST(4294967295 AS BIGINT) AS c FROM own
  UNION ALL
  SELECT conv_id, digits, k + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END
  FROM (SELECT *, CASE WHEN k % 8 = 0 THEN xor(c, CAST(ascii(substr(digits, k // 8 + 1, 1)) AS BIGINT)) ELSE c END AS x
        FROM crc WHERE k < 8 * length(digits))),
shared AS (SELECT conv_id, xor(c, 4294967295) % 9 AS h FROM crc WHERE k = 8 * length(digits)),
rebuilt AS (
  SELECT own.conv_id, list_concat(coalesce(list_slice(donor.turns, 1, h), []), list_slice(own.turns, h + 1, len(own.turns))) AS turns
  FROM own JOIN shared USING (conv_id) LEFT JOIN own AS donor ON donor.conv_id = own.conv_id - own.conv_id % 5),
path AS (
  SELECT conv_id, d AS depth, list_slice(turns, 1, d) AS prefix, len(turns) = d AS ends
  FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM rebuilt)),
node AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
         CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * octet_length(encode(prefix[depth].t)) END AS own_saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM path GROUP BY depth, prefix),
child AS (SELECT depth - 1 AS depth, list_slice(prefix, 1, depth - 1) AS prefix, count(*) AS n FROM node WHERE depth > 0 GROUP BY ALL),
counted AS (SELECT node.*, coalesce(child.n, 0) AS n_children FROM node LEFT JOIN child ON child.depth = node.depth AND child.prefix = node.prefix),
total AS (
  SELECT d AS depth, list_slice(prefix, 1, d) AS prefix, sum(own_saved) AS saved, count(*) FILTER (n_children = 0) AS leaves
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM counted) GROUP BY ALL)
SELECT c.conv_id, CAST(c.depth AS BIGINT) AS depth, parent.conv_id AS parent_conv_id, c.n_convs, CAST(c.n_children AS BIGINT) AS n_children,
       CAST(t.leaves AS BIGINT) AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN total t ON t.depth = c.depth AND t.prefix = c.prefix
LEFT JOIN node parent ON parent.depth = c.depth - 1 AND parent.prefix = list_slice(c.prefix, 1, c.depth - 1) AND c.depth > 0
"""
