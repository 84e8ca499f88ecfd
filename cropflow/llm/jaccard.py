"""Operator 7: exact n-gram Jaccard join by token groups, reduced to linked components.

A document's set is its distinct 5-word shingles (52-bit hashes); two sets are
linked when 100 * |intersection| >= 80 * |union|. Documents with equal sets
form one *class*; only classes are compared.

Token-group matrix. Classes are partitioned into groups of similar sets (by
their smallest shingle hash; a group over twice ``GROUP_SHINGLES`` is split), and
a group's token union is the set of its members' shingles. A class Q can only
link into a group G if their overlap reaches ``need(|Q|)`` = ceil(0.8 |Q|), hence:

1. bound: let shared(n) be a sixteenth of n, 4 at least. Of Q's first
   |Q| - need + shared(|Q|) shingles in one global order (rare first), as many
   as shared() of the smallest set Q can link with must lie in the union of the
   same prefixes of G's members. Rows (shingle, group, class) are shuffled by
   shingle; each run of equal shingles gives (class, group) hits for every
   group met in it, which are counted; pairs below the bound never open the group.
2. open: the sets of the qualifying classes travel to the groups they may link
   into. Q's overlap with the full union is checked first, then its overlap
   with every member is counted from the union's member lists. One edge per
   linked local component is kept.

The order puts the ``FREQUENT`` most frequent shingles (met several times in one
block of text and then summed over all documents) last, so common passages
rarely reach a prefix; any fixed list gives exact results. A class visits only
groups numbered below its own, so each pair of groups meets once.

Plan: three maps over whole texts and two shuffles (prefix rows; qualifying
sets), no document pairs. A run of one shingle is streamed in constant memory,
a group holds a bounded number of shingles, copies are collapsed per batch
before any shuffle, so a group of copies of any size adds one row per batch.

Edge cases: null or blank text: empty set, n_shingles 0, linked with nothing;
fewer than five words: one shingle of all words; rows that repeat an id are one
node that has the links of all its texts; a null id has its own component_id null;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bloom
from .components import components
from .store import written
from .text import Block, _string_buffers, blocks, fold_ascii, mix64, ranges, values, window_hash, word_bounds, word_hashes, word_prefix

SHINGLE, PERCENT = 5, 80
#: Least prefix shingles two linked sets must share (a sixteenth of long sets);
#: sets under 4 shingles link only with equal ones.
SHARED, SHARED_PART = 4, 16
GROUP_SHINGLES, FREQUENT, FREQUENT_IN_BLOCK = 1 << 20, 1 << 17, 2
#: Bytes of text handled at once.
BLOCK = 1 << 20
#: Bits of a shingle hash; the rest of a sort key holds the document's place in its block.
BITS = 52
#: Rows of one shingle held at once while its run is streamed.
RUN_ROWS = 1 << 18


def need(n: np.ndarray) -> np.ndarray:
    """Smallest overlap of a set of n with any set it links with."""
    return -(-PERCENT * n // 100)


def shared(n: np.ndarray) -> np.ndarray:
    """Prefix shingles a set of n offers beyond its first n - need(n)."""
    return np.maximum(SHARED, n // SHARED_PART)


def shingle_sets(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every document of the block, back to back, and their offsets."""
    data = fold_ascii(block.data)
    starts, ends, first = word_bounds(Block(block.rows, data, block.offsets))
    prefix = word_prefix(word_hashes(data, starts, ends))
    n = np.diff(first)
    counts = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(n)), counts)
    begin = first[doc] + ranges(counts)
    hashes = window_hash(prefix, begin, np.minimum(n, SHINGLE)[doc]) >> np.uint64(64 - BITS)
    key = (doc.astype(np.uint64) << np.uint64(BITS)) | hashes
    key.sort()
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    cut = np.searchsorted(key, np.arange(len(n) + 1, dtype=np.uint64) << np.uint64(BITS))
    return key & np.uint64((1 << BITS) - 1), cut


def _small_blocks(batch: pa.RecordBatch) -> Iterator[tuple[Block, np.ndarray, np.ndarray]]:
    most = 1 << (64 - BITS)
    for b in blocks(batch, "text", BLOCK):
        for i in range(0, len(b.rows), most):
            o = b.offsets[i : i + most + 1]
            part = Block(b.rows[i : i + most], b.data[o[0] : o[-1]], o - o[0])
            yield part, *shingle_sets(part)


def _class_ids(sets: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """64-bit hash of each whole set (0 for the empty set)."""
    prefix = word_prefix(mix64(sets + np.uint64(1)))
    n = np.diff(cut)
    return np.where(n > 0, window_hash(prefix, cut[:-1], n) ^ mix64(n.astype(np.uint64)), np.uint64(0)).view(np.int64)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kind 0: id = doc_id, cls, n, smallest shingle; kind 1: id = shingle often met in a block, n = documents."""
    for batch in batches:
        ids = batch.column("doc_id")
        for block, sets, cut in _small_blocks(batch):
            n, rows = np.diff(cut), len(block.rows)
            low = np.zeros(rows, dtype=np.int64)
            low[n > 0] = sets[cut[:-1][n > 0]].view(np.int64)
            token, counts = np.unique(sets, return_counts=True)
            often = counts >= FREQUENT_IN_BLOCK
            token, counts = token[often].view(np.int64), counts[often]
            zero = np.zeros(len(token), np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat([0, 1], [rows, len(token)]).astype(np.int32)),
                pa.concat_arrays([ids.take(pa.array(block.rows)).cast(pa.int64()), pa.array(token)]),
                pa.array(np.concatenate([_class_ids(sets, cut), zero])), pa.array(np.concatenate([n, counts]).astype(np.int64)),
                pa.array(np.concatenate([low, zero]))], ["kind", "id", "cls", "n", "low"])


def group_of(low: np.ndarray, cls: np.ndarray, groups: int, splits: dict[int, int]) -> np.ndarray:
    """Group of each class: by its smallest shingle, oversized groups dealt out further by class."""
    g = (mix64(low.view(np.uint64)) % np.uint64(groups)).astype(np.int64)
    out = g << 20
    for hot, k in splits.items():
        here = g == hot
        out[here] += (cls[here].view(np.uint64) % np.uint64(k)).astype(np.int64)
    return out


def _prefix_rows(groups: int, splits: dict[int, int], common):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, rank = common.value  # shingles in order of hash, and their place by frequency (rarest first)
        for batch in batches:
            seen: set[int] = set()
            for _, sets, cut in _small_blocks(batch):
                n, cls = np.diff(cut), _class_ids(sets, cut)
                fresh = np.zeros(len(n), dtype=bool)
                for i in np.flatnonzero(n >= SHARED):
                    c = int(cls[i])
                    fresh[i] = c not in seen
                    seen.add(c)
                wanted = np.where(fresh, n - need(n) + shared(n), 0)
                doc = np.repeat(np.arange(len(n)), n)
                slot = np.minimum(np.searchsorted(frequent, sets), max(0, len(frequent) - 1))
                is_common = frequent[slot] == sets if len(frequent) else np.zeros(len(sets), dtype=bool)
                rare = ~is_common
                upto = np.concatenate([[0], np.cumsum(rare)])
                chosen = rare & (upto[:-1] - upto[cut[:-1]][doc] < wanted[doc])
                left = wanted - (upto[cut[1:]] - upto[cut[:-1]])
                at = np.flatnonzero(is_common & (left[doc] > 0))
                if len(at):
                    order = at[np.lexsort((rank[slot[at]], doc[at]))]
                    place = ranges(np.bincount(doc[order], minlength=len(n)))
                    chosen[order[place < left[doc[order]]]] = True
                low = np.zeros(len(n), dtype=np.int64)
                low[n > 0] = sets[cut[:-1][n > 0]].view(np.int64)
                g, at = group_of(low, cls, groups, splits), np.flatnonzero(chosen)
                yield pa.RecordBatch.from_arrays([pa.array(sets[at].view(np.int64)), pa.array(g[doc[at]]), pa.array(cls[doc[at]])],
                                                 ["token", "grp", "cls"])
    return emit


def _run_hits(token: np.ndarray, grp: np.ndarray, cls: np.ndarray, real: np.ndarray, long_run: bool) -> tuple[np.ndarray, np.ndarray]:
    """(class, group) for every real row and every group up to its own in its run of equal shingles.

    Rows are sorted by shingle and group. A run of one class gives nothing, unless it is ``long_run``, of which more may follow.
    """
    new_run = np.concatenate([[True], token[1:] != token[:-1]])
    new_grp = new_run | np.concatenate([[True], grp[1:] != grp[:-1]])
    run = np.cumsum(new_run) - 1
    begins = np.flatnonzero(new_run)
    several = np.full(len(begins), long_run)
    several[run[1:][(run[1:] == run[:-1]) & (cls[1:] != cls[:-1])]] = True
    place = np.cumsum(new_grp) - 1
    groups, first_place = grp[new_grp], place[begins]
    take = np.flatnonzero(several[run] & real)
    counts = place[take] - first_place[run[take]] + 1
    return np.repeat(cls[take], counts), groups[np.repeat(first_place[run[take]], counts) + ranges(counts)]


def _hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams rows sorted by (shingle, group); only the run at the end of a batch is carried on."""
    held = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)]

    def out(parts, long_run=False):
        c, g = _run_hits(*parts, long_run) if len(parts[0]) else (np.zeros(0, np.int64),) * 2
        return pa.RecordBatch.from_arrays([pa.array(c), pa.array(g)], ["cls", "grp"])

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [values(batch, c) for c in ("token", "grp", "cls")] + [np.ones(batch.num_rows, bool)]
        cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
        cut = int(np.searchsorted(cols[0], cols[0][-1]))
        yield out([c[:cut] for c in cols])
        held = [c[cut:] for c in cols]
        if len(held[0]) > RUN_ROWS:
            yield out(held, long_run=True)
            # the run goes on with one stand-in per group met, of a class of its own
            keep = np.flatnonzero(np.concatenate([[True], held[1][1:] != held[1][:-1]]))
            held = [c[keep] for c in held]
            held[2], held[3] = np.arange(len(keep), dtype=np.int64), np.zeros(len(keep), bool)
    yield out(held)


def _class_sets(active):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = values(batch, "doc_id")
            for block, sets, cut in _small_blocks(batch):
                cls = _class_ids(sets, cut)
                some = np.flatnonzero(bloom.maybe(active.value, mix64(cls.view(np.uint64))) & (np.diff(cut) >= SHARED))
                yield pa.RecordBatch.from_arrays([
                    pa.array(cls[some]), pa.array(ids[block.rows[some]]),
                    pa.array([sets[cut[i] : cut[i + 1]].tobytes() for i in some], pa.binary())], ["cls", "doc_id", "tokens"])
    return emit


class _Opened:
    """A group in one task: its members' shingles as one sorted list with the members that hold each."""

    def __init__(self, sets: list[np.ndarray], ids: np.ndarray):
        self.ids, self.n = ids, np.array([len(s) for s in sets])
        token = np.concatenate(sets)
        order = np.argsort(token, kind="stable")
        self.token, self.member = token[order], np.repeat(np.arange(len(sets)), self.n)[order]
        self.union = np.unique(self.token)
        self.parent = np.arange(len(sets))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return int(i)

    def matches(self, tokens: np.ndarray) -> np.ndarray:
        """Members linked with a set."""
        spot = np.minimum(np.searchsorted(self.union, tokens), len(self.union) - 1)
        if (self.union[spot] == tokens).sum() < need(len(tokens)):
            return np.zeros(0, np.int64)
        low, high = np.searchsorted(self.token, tokens), np.searchsorted(self.token, tokens, side="right")
        counts = high - low
        overlap = np.bincount(self.member[np.repeat(low, counts) + ranges(counts)], minlength=len(self.n))
        return np.flatnonzero((overlap > 0) & (100 * overlap >= PERCENT * (self.n + len(tokens) - overlap)))


def _open_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (group, visitor, class): members of a group first, then its visitors.
    Gives edges (a, b) between classes, one per visitor and linked local component."""
    group, members, last, opened = None, [], None, None

    def close() -> tuple[list, list]:
        a, b = [], []
        nonlocal opened
        opened = _Opened([t for _, t in members], np.array([c for c, _ in members], dtype=np.int64)) if members else None
        for i, (c, t) in enumerate(members):
            for j in opened.matches(t):
                if j < i and (x := opened.root(i)) != (y := opened.root(j)):
                    opened.parent[max(x, y)] = min(x, y)
                    a.append(c), b.append(int(opened.ids[j]))
        return a, b

    for batch in batches:
        a, b = [], []
        raw, cut = _string_buffers(batch.column("tokens"))
        for k, (g, visitor, c) in enumerate(zip(*(batch.column(x).to_pylist() for x in ("grp", "visitor", "cls")))):
            if g != group:
                if opened is None and members:
                    x, y = close()
                    a += x
                    b += y
                group, members, opened, last = g, [], None, None
            if (visitor, c) == last:
                continue  # another row of the same class
            last = (visitor, c)
            tokens = raw[cut[k] : cut[k + 1]].view(np.uint64)
            if not visitor:
                members.append((c, tokens.copy()))  # a copy, so that the batch can go
                continue
            if opened is None and members:
                x, y = close()
                a += x
                b += y
            if opened is not None:
                met = {}
                for j in opened.matches(tokens):
                    met.setdefault(opened.root(j), int(opened.ids[j]))
                a += [c] * len(met)
                b += met.values()
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    if opened is None and members:
        a, b = close()
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def class_links(docs: DataFrame, classes: DataFrame, common: np.ndarray) -> DataFrame:
    """Edges (a, b) between linked classes, enough to connect every component.

    docs (doc_id, text) without nulls; classes (cls, rep, n, low) of its sets;
    common: frequent shingles, most frequent first.
    """
    sc = docs.sparkSession.sparkContext
    comparable = classes.where(F.col("n") >= SHARED)
    total = comparable.agg(F.sum("n")).first()[0] or 0
    groups = max(1, total // GROUP_SHINGLES)
    # sizes by group as the tasks will compute it; only oversized groups (at most total / 2 GROUP_SHINGLES) come back
    sizes = comparable.select("low", "n").mapInArrow(_group_sizes(groups), "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))
    splits = {r["g"]: min(1 << 20, -(-r["n"] // GROUP_SHINGLES)) for r in sizes.where(F.col("n") > 2 * GROUP_SHINGLES).collect()}
    order = np.argsort(common)
    place = (len(common) - 1 - order).astype(np.int64)  # rarest of the frequent first
    rows = docs.mapInArrow(_prefix_rows(groups, splits, sc.broadcast((common[order], place))), "token long, grp long, cls long")
    hits = rows.repartition("token").sortWithinPartitions("token", "grp").mapInArrow(_hits, "cls long, grp long")
    # the smallest set that n can link with holds need(n) shingles
    smallest = F.ceil(F.col("n") * PERCENT / 100)
    bound = F.greatest(F.lit(SHARED), F.floor(smallest / SHARED_PART))
    counts = hits.groupBy("cls", "grp").agg(F.count("*").alias("hits")).where(F.col("hits") >= SHARED)
    open_pairs = counts.join(classes.select("cls", "n"), "cls").where(F.col("hits") >= bound).select("cls", "grp")
    open_pairs = written(open_pairs, "jaccard-open")
    active = open_pairs.select("cls").distinct().join(classes.select("cls", "rep", "low"), "cls")
    active = written(active.mapInArrow(_own_groups(groups, splits), "cls long, rep long, own long, h long"), "jaccard-active")
    maybe = sc.broadcast(bloom.build(active, "h"))
    visits = open_pairs.join(active.drop("h"), "cls").select("cls", F.col("rep").alias("doc_id"), "grp", (F.col("grp") != F.col("own")).alias("visitor"))
    sets = docs.mapInArrow(_class_sets(maybe), "cls long, doc_id long, tokens binary")
    travelling = sets.join(visits.hint("shuffle_hash"), ["cls", "doc_id"]).select("grp", "visitor", "cls", "tokens")
    opened = travelling.repartition("grp").sortWithinPartitions("grp", "visitor", "cls")
    return opened.mapInArrow(_open_groups, "a long, b long")


def _group_sizes(groups: int):
    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g, inverse = np.unique(group_of(values(batch, "low"), np.zeros(batch.num_rows, np.int64), groups, {}) >> 20, return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(np.bincount(inverse, weights=values(batch, "n"), minlength=len(g)).astype(np.int64))], ["g", "n"])
    return sizes


def _own_groups(groups: int, splits: dict[int, int]):
    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls = values(batch, "cls")
            yield pa.RecordBatch.from_arrays([batch.column("cls"), batch.column("rep"), pa.array(group_of(values(batch, "low"), cls, groups, splits)),
                                              pa.array(mix64(cls.view(np.uint64)).view(np.int64))], ["cls", "rep", "own", "h"])
    return own


def linked_components(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_shingles, component_id."""
    docs = docs.select("doc_id", "text")
    described = written(docs.mapInArrow(_describe, "kind int, id long, cls long, n long, low long"), "jaccard-sets")
    rows = described.where("kind = 0").select(F.col("id").alias("doc_id"), "cls", "n", "low")
    # a bounded list: the FREQUENT most frequent shingles
    common = (described.where("kind = 1").groupBy("id").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "id").limit(FREQUENT)
              .select("id").toPandas()["id"].to_numpy(np.int64).view(np.uint64))
    known = rows.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = written(known.groupBy("cls").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("low").alias("low")), "jaccard-classes")
    links = written(class_links(docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()), classes, common), "jaccard-links")
    reps = classes.select("cls", "rep")
    # smallest id of each class joined in on both ends; then ids whose rows lie in several classes
    edges = (links.join(reps, F.col("a") == F.col("cls")).select(F.col("rep").alias("x"), "b")
             .join(reps, F.col("b") == F.col("cls")).select(F.col("x").alias("a"), F.col("rep").alias("b")))
    of_row = written(known.join(reps, "cls").select("doc_id", "rep").distinct(), "jaccard-reps")
    several = of_row.groupBy("doc_id").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).where("least < most")
    bridges = of_row.join(several.select("doc_id", "least"), "doc_id").select(F.col("least").alias("a"), F.col("rep").alias("b"))
    roots = components(edges.unionByName(bridges), "jaccard-components")
    by_id = of_row.groupBy("doc_id").agg(F.min("rep").alias("rep"))
    placed = by_id.join(roots, F.col("rep") == F.col("node"), "left").select("doc_id", F.coalesce("root", "rep").alias("component"))
    return rows.join(placed, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def op7_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return linked_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
