"""N-gram Jaccard join: all links between documents whose sets of word shingles overlap enough, by signature trees.

1. Documents of one set form a class, named by the set's 64-bit fingerprint (and joined through their smallest id).
2. Blocks. Shingles are put in one order for all documents: those counted very often in the corpus last, else those of
   longer words first (short words meet by chance), then by hash. Two linked sets share one of their first
   n - ceil(t n) + 1 shingles, so each set enters the blocks of these. Which shingles count as frequent only shifts work
   between blocks, never links; at most FREQUENT are told apart, which bounds what is broadcast. Blocks are cut at gaps
   in their sets' sizes that no link can span.
3. The blocks that share a first member are one group, since near copies meet in many blocks of the same members. A
   group of more than STRIP members is cut into strips, each with the group's PIVOTS besides. What a strip links with
   a pivot is linked through it; only the members outside the group's largest component so far are then compared with
   the other strips. So one huge group of near copies costs about its members times the pivots, not their square.
4. Signature trees over each group, in two passes. A leaf holds a set's token bitmap and size, a node the OR of its
   children's bitmaps and the range of their sizes. Both sides of the dual traversal descend only where the largest
   overlap possible, from the bits in common and the sizes, still reaches the threshold. The first pass, with hashed
   bitmaps of twice a set's size, finds which members may link with any other; the second has their whole sets, gives a
   bit to every shingle that two of them share, and so counts overlaps exactly. Members that are linked already are not
   compared again, so a group gives at most one link less than its members.
5. Components by alternating large-star and small-star rounds, cut off by checkpoints.

Set equality and overlap are those of 64-bit shingle hashes. Bitmaps only prune, at any threshold: those of larger sets
are folded onto the smaller ones' width. No candidate is dropped otherwise.

Defined cases: a null or empty text, or one of blanks, has an empty set and is linked with nothing; a text with fewer
words than a shingle is one shingle, unequal to those of other lengths; null ids never name a component
that has another id; repeated rows are one class; other columns are ignored by links(). keep_one() judges rows, not ids:
rows of one id with texts that aren't linked all stay, those without words too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspar.llm._exchange import group_count, pack, unpack
from loomspar.llm._lineage import cut
from loomspar.llm._rows import chunks, free_name, row_hash, small_batches
from loomspar.llm._tokens import U, mix, signed, texts_of, whole, windows, words

FREQUENT = 1 << 21
#: A shingle is frequent from this count on, or from such a share of all shingles that no more than FREQUENT reach it.
FREQUENT_FROM = 16
SLICE_BYTES = 2 << 20
#: Shingles that a task counts at once. When there are more, all lose what the first beyond has: so a count falls short by
#: at most the task's shingles / HELD, and no shingle goes unseen that is more frequent than that.
HELD, HELD_SLICES, REPORT_FROM = 1 << 20, 4, 2
LEAF, STRIP, PIVOTS, BLOCK_PIECE, PARTS = 16, 512, 4, 1 << 16, 64
#: Groups of documents to a bucket of shingles, and the most prefix shingles that a bucket holds on average.
BUCKET_GROUPS, BUCKET_ENTRIES = 4, 1 << 22
#: Groups beyond STRIP are told to the executors up to this number, else joined.
TOLD_GROUPS = 1 << 17
#: Pairs of nodes looked at together, and bytes of a group's exact bitmaps; beyond these, shingles share bits and overlaps
#: are counted from the sets.
PAIRS, BITMAP_BYTES = 1 << 16, 32 << 20
BLOCK_ROWS = 1 << 20
#: Documents whose sets are compared are told to the executors by their ids up to this number, else joined.
TOLD_IDS = 1 << 20
#: Verification compares sets by 48 bits of the shingles' hashes: two sets of n meet by chance in under n * n / 2**48.
SHORT = U((1 << 48) - 1)


class Rule:
    """Two sets link when den * overlap >= num * union; shingles have `words` words."""

    def __init__(self, words: int = 4, num: int = 85, den: int = 100) -> None:
        self.words, self.num, self.den = words, num, den

    def prefix(self, n: np.ndarray) -> np.ndarray:
        return n - -(-self.num * n // self.den) + 1

    def sizes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether sets of these sizes can link."""
        return self.den * np.minimum(a, b) >= self.num * np.maximum(a, b)

    def links(self, overlap: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.den * overlap >= self.num * (a + b - overlap)


def sets(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, the bytes in each one's words, where each text's shingles begin (one
    more at the end), and fingerprints."""
    w = words(texts, lower=True)
    at, keys = windows(w.hash, w.off, k)
    owner = w.text_of_word()[at] if len(at) else np.empty(0, np.int64)
    run = np.concatenate((np.zeros(1, np.int64), np.cumsum(w.end - w.start)))
    length = run[at + k] - run[at]
    short = np.flatnonzero((w.counts > 0) & (w.counts < k))
    if len(short):
        keys = np.concatenate((keys, np.array([whole(w.hash[w.off[i] : w.off[i + 1]]) for i in short], U)))
        owner = np.concatenate((owner, short))
        length = np.concatenate((length, run[w.off[short + 1]] - run[w.off[short]]))
    order = np.lexsort((keys, owner))
    keys, owner, length = keys[order], owner[order], length[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    keys, owner, length = keys[new], owner[new], length[new]
    off = np.searchsorted(owner, np.arange(len(texts) + 1))
    sums = np.concatenate((np.zeros(1, U), np.cumsum(mix(keys ^ U(0x5E7)), dtype=U)))
    size = np.diff(off)
    return keys, length, off, mix(sums[off[1:]] - sums[off[:-1]] + size.astype(U) * U(0x9E3779B97F4A7C15))


def _slices(batches: Iterator[pa.RecordBatch], k: int):
    for batch in batches:
        for part in chunks(batch, "text", SLICE_BYTES) if batch.num_rows else ():
            yield part, *sets(texts_of(part.column("text")), k)


def _first_of(marks: np.ndarray, size: np.ndarray) -> np.ndarray:
    """One text for each distinct set of a slice; texts without words are left out."""
    _, first = np.unique(marks, return_index=True)
    return np.sort(first[size[first] > 0])


def _members(rule: Rule, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, _, _, off, marks in _slices(batches, rule.words):
        size = np.diff(off)
        yield pa.RecordBatch.from_arrays([part.column("id"), part.column("key"), pa.array(size), pa.array(signed(marks), mask=size == 0)], names=["id", "key", "n", "mark"])


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys with their counts added up, the most frequent HELD of them, less the count of the first beyond."""
    key, of = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    count = np.bincount(of, np.concatenate([c for _, c in parts]), minlength=len(key)).astype(np.int64)
    if len(key) > HELD:
        count -= np.partition(count, len(key) - HELD - 1)[len(key) - HELD - 1]
        key, count = key[count > 0], count[count > 0]
    return key, count


def _counts(rule: Rule, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's shingles with their counts, and under a null key the number of all. Reported are those that occur at least
    half as often as a frequent one does on average, and twice."""
    parts, total = [(np.empty(0, U), np.empty(0, np.int64))], 0
    for _, keys, _, off, marks in _slices(batches, rule.words):
        size = np.diff(off)
        first = _first_of(marks, size)
        mine = np.concatenate([np.arange(off[i], off[i + 1]) for i in first.tolist()] or [np.empty(0, np.int64)]).astype(np.int64)
        parts.append(np.unique(keys[mine], return_counts=True))
        total += len(mine)
        if len(parts) > HELD_SLICES:
            parts = [_merged(parts)]
    key, count = _merged(parts)
    often = count >= max(REPORT_FROM, total // (2 * FREQUENT))
    yield pa.RecordBatch.from_arrays([pa.array([None, *signed(key[often]).tolist()], pa.int64()), pa.array([total, *count[often].tolist()], pa.int64())], names=["key", "n"])


def _frequent(docs: DataFrame, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, sorted, and into how many strips the block of each is cut."""
    found = cut(docs.mapInArrow(partial(_counts, rule), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")))
    total = found.where("key IS NULL").agg(F.sum("n")).first()[0] or 0
    least = max(FREQUENT_FROM, -(-total // FREQUENT))
    rows = found.where((F.col("key").isNotNull()) & (F.col("n") >= least)).collect()  # FREQUENT at most, as their counts add up to total at most
    keys, strips = np.array([r.key for r in rows], np.int64).view(U), np.array([-(-r.n // BLOCK_ROWS) for r in rows], np.int64)
    order = np.argsort(keys)
    return keys[order], strips[order]


def _grid(keys: np.ndarray, marks: np.ndarray, frequent: np.ndarray, strips: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Block and entry for all entries. A block cut into s strips becomes the s (s + 1) / 2 pairs of strips, so that each
    two of its sets still meet and no task reads it whole."""
    entry, block = np.arange(len(keys)), keys
    if len(frequent) and strips.max() > 1:
        at = np.minimum(np.searchsorted(frequent, keys), len(frequent) - 1)
        n = np.where(frequent[at] == keys, strips[at], 1)
        entry = np.repeat(entry, n)
        other = np.arange(len(entry)) - np.repeat(np.cumsum(n) - n, n)
        n = n[entry]
        own = (marks[entry] % n.astype(U)).astype(np.int64)
        cell = np.minimum(own, other) * n + np.maximum(own, other)
        block = np.where(n > 1, mix(keys[entry] + mix(cell.astype(U))), keys[entry])
    return block, entry


def _prefixes(rule: Rule, shared, buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By bucket of shingles: shingle, set and set size, packed; one set of equal ones in a slice."""
    frequent, strips = shared.value
    for _, keys, length, off, marks in _slices(batches, rule.words):
        size = np.diff(off)
        owner = np.repeat(np.arange(len(size)), size)
        late = frequent[np.minimum(np.searchsorted(frequent, keys), len(frequent) - 1)] == keys if len(frequent) else np.zeros(len(keys), bool)
        order = np.lexsort((keys, -length, late, owner))
        keys, owner = keys[order], owner[order]
        chosen = np.zeros(len(size), bool)
        chosen[_first_of(marks, size)] = True
        use = (np.arange(len(keys)) - off[owner] < rule.prefix(size)[owner]) & chosen[owner]
        keys, owner = keys[use], owner[use]
        keys, entry = _grid(keys, marks[owner], frequent, strips)
        owner = owner[entry]
        bucket = keys % U(buckets)
        order = np.lexsort((keys, bucket))
        keys, owner, bucket = keys[order], owner[order], bucket[order]
        edges = np.searchsorted(bucket, np.arange(buckets + 1).astype(U))
        full = np.flatnonzero(np.diff(edges))
        blobs = [pack(keys[a:b], marks[owner[a:b]], size[owner[a:b]].astype(np.uint32)) for a, b in zip(edges[full].tolist(), edges[full + 1].tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(blobs, pa.binary())], names=["b", "blob"])


def _blocks(rule: Rule, key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The blocks with two sets or more, by their least member: members of all its blocks, each once (in parts, if many)."""
    parts = [unpack(b) for b in table["blob"].to_pylist()]
    keys, marks, size = (np.concatenate([p[i] for p in parts]) for i in range(3))
    order = np.lexsort((marks, size, keys))
    keys, marks, size = keys[order], marks[order], size[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (marks[1:] != marks[:-1])
    keys, marks, size = keys[new], marks[new], size[new]
    size = size.astype(np.int64)
    # Sets on the two sides of a gap between sizes that can't link need not meet.
    apart = rule.num * size[1:] > rule.den * size[:-1]
    head = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | apart)))
    stop = np.append(head[1:], len(keys))
    many = stop - head > 1
    head, stop = head[many], stop[many]
    sums = np.concatenate((np.zeros(1, U), np.cumsum(mix(marks ^ U(0xB10C)), dtype=U)))
    name = mix(sums[stop] - sums[head] + (stop - head).astype(U))
    _, once = np.unique(name, return_index=True)
    pairs = [np.empty((0, 2), np.int64)]
    for a, b in zip(head[once].tolist(), stop[once].tolist()):
        own = signed(marks[a:b])
        pairs.append(np.column_stack((np.full(b - a, own.min()), own)))
    lead, mark = np.unique(np.concatenate(pairs), axis=0).T
    at = np.append(np.flatnonzero(np.concatenate(([True], lead[1:] != lead[:-1])) if len(lead) else []), len(lead))
    rows = []
    for a, b in zip(at.tolist(), at[1:].tolist()):
        part = mark[a:b] & (PARTS - 1) if b - a > BLOCK_PIECE else np.zeros(b - a, np.int64)
        rows += [(int(lead[a]), q, pack(mark[a:b][part == q])) for q in np.unique(part).tolist()]
    cols = list(zip(*rows)) or [()] * 3
    return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary())], names=["lead", "part", "members"])


def _union(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Members of a group from all buckets, each once."""
    mark = np.unique(np.concatenate([signed(unpack(m)[0]) for m in table["members"].to_pylist()]))
    return pa.table({"lead": pa.array(np.full(len(mark), key[0].as_py()), pa.int64()), "mark": pa.array(mark)})


def _bits(n: int) -> int:
    """Bits of the signature of a set of n: a power of two, twice n at least."""
    return max(128, 1 << (2 * n - 1).bit_length())


def _signature(keys: np.ndarray) -> np.ndarray:
    bits = _bits(len(keys))
    out = np.zeros(bits, np.uint8)
    out[(keys % U(bits)).astype(np.int64)] = 1
    return np.packbits(out)


def _packed_set(keys: np.ndarray) -> bytes:
    return pack(np.diff(np.sort(keys & SHORT), prepend=U(0)))


def _described(rule: Rule, told, how, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids = None if told is None else told.value
    if ids is not None:
        batches = (b.filter(pa.array(np.isin(b.column("key").to_numpy(), ids))) for b in batches)
    for _, keys, _, off, marks in _slices(batches, rule.words):
        blobs = [how(keys[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(signed(marks)), pa.array(blobs, pa.binary())], names=["mark", "described"])


def _describe(docs: DataFrame, reps: DataFrame, wanted: DataFrame, rule: Rule, how, name: str) -> DataFrame:
    """mark and how() of its set for the wanted marks, from the text of one document of each class. Rows that repeat an id
    may give a set twice."""
    ids = cut(wanted.select("mark").distinct().join(reps, "mark").select(F.col("key").alias("wanted")))
    told = None
    if ids.count() <= TOLD_IDS:
        told = docs.sparkSession.sparkContext.broadcast(np.sort(np.array([r.wanted for r in ids.collect()], np.int64)))
        texts = docs
    else:
        texts = docs.join(ids, F.col("key") == F.col("wanted"), "left_semi")
    return cut(texts.mapInArrow(partial(_described, rule, told, how), "mark long, described binary").withColumnRenamed("described", name))


def _plain_set(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob)[0], dtype=U)


def _by_group(fn, rule: Rule):
    return lambda key, table: fn(rule, key, table)


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node of the distinct links (a, b), a < b, is a centre or the leaf of one: then all centres are their
    components' smallest nodes, and a round would change nothing."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(0).alias("leaf")), F.struct(F.col("b").alias("node"), F.lit(1).alias("leaf")))).alias("e")).select("e.*")
    roles = ends.groupBy("node").agg(F.sum("leaf").alias("leaf"), F.count(F.lit(1)).alias("n"))
    return roles.where("leaf > 0 AND n > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for all nodes of the links (a, b), by alternating stars."""
    flat = lambda e: e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    current = cut(flat(edges))
    while not _are_stars(current):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
        large = flat(large)
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").select(F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("a").alias("b")), F.struct(F.col("m").alias("a"), F.col("b").alias("b")))).alias("e")).select("e.a", "e.b")
        current = cut(flat(small))
    return current.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(current.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


class Tree:
    """A signature tree. A node: OR of the bitmaps, smallest and largest set, and the most shingles that a set below has
    beyond its bits. levels[0] are the sets, in the order of their sizes."""

    def __init__(self, maps: np.ndarray, size: np.ndarray, spare: np.ndarray) -> None:
        self.levels = [(maps, size, size, spare)]
        while len(self.levels[-1][0]) > 1:
            m, lo, hi, more = self.levels[-1]
            at = np.arange(0, len(m), LEAF)
            self.levels.append((np.bitwise_or.reduceat(m, at, 0), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at), np.maximum.reduceat(more, at)))


def _may_link(rule: Rule, x: tuple, y: tuple, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether sets below nodes i of x and j of y can link. Sets share at most a shingle for each bit that both nodes
    have, and those that share their bits with others."""
    common = np.bitwise_count(x[0][i] & y[0][j]).sum(1, dtype=np.int64)
    most = np.minimum(np.minimum(x[2][i], y[2][j]), common + np.minimum(x[3][i], y[3][j]))
    return rule.links(most, np.maximum(x[1][i], most), np.maximum(y[1][j], most))


def _children(parent: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    first = parent * LEAF
    count = np.minimum(first + LEAF, n) - first
    return np.repeat(np.arange(len(parent)), count), np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())


def traverse(rule: Rule, x: Tree, y: Tree, wanted) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of sets of x and y that may link and that wanted(i, j) still asks for, by descending both trees together; of
    a tree with itself, each pair once. At most about PAIRS * LEAF * LEAF pairs are held at a level."""
    stack = [(len(x.levels) - 1, len(y.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        a, b, i, j = stack.pop()
        if len(i) > PAIRS:
            stack += [(a, b, i[c : c + PAIRS], j[c : c + PAIRS]) for c in range(0, len(i), PAIRS)]
            continue
        if a == b == 0:
            ask = wanted(i, j) if x is not y else wanted(i, j) & (i < j)
            i, j = i[ask], j[ask]
        fine = _may_link(rule, x.levels[a], y.levels[b], i, j)
        i, j = i[fine], j[fine]
        if not len(i):
            continue
        if a == b == 0:
            yield i, j
            continue
        deeper_a, deeper_b = a >= b and a > 0, b >= a and b > 0
        if deeper_a:
            row, i = _children(i, len(x.levels[a - 1][0]))
            j, a = j[row], a - 1
        if deeper_b:
            row, j = _children(j, len(y.levels[b - 1][0]))
            i, b = i[row], b - 1
        if x is y:
            i, j = i[i <= j], j[i <= j]
        stack.append((a, b, i, j))


def _promising(rule: Rule, key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Members of a cell whose hashed bitmaps leave room for a link with a member that has another label."""
    size = table["n"].to_numpy()
    _, label = np.unique(table["label"].to_numpy(), return_inverse=True)
    maps = [np.frombuffer(b, np.uint8) for b in table["signature"].to_pylist()]
    width = np.array([len(m) for m in maps])
    found = np.zeros(len(size), bool)

    def tree(rows: np.ndarray, to: int) -> tuple[Tree, np.ndarray]:
        """Wider bitmaps are folded onto the narrower ones: a shingle's bit is its hash modulo the width."""
        rows = rows[np.argsort(size[rows], kind="stable")]
        m = np.stack([maps[r] if len(maps[r]) == to else np.bitwise_or.reduce(maps[r].reshape(-1, to), 0) for r in rows.tolist()]).view(np.uint64)
        return Tree(m, size[rows], size[rows] - np.bitwise_count(m).sum(1, dtype=np.int64)), rows

    widths = np.unique(width).tolist()
    for w in widths:
        own, rows = tree(np.flatnonzero(width == w), w)
        trees = [(own, rows)]
        for v in widths:
            wider = np.flatnonzero((width == v) & (rule.num * size <= rule.den * int(size[rows].max()))) if v > w else ()
            if len(wider):
                trees.append(tree(wider, w))
        for other, others in trees:
            for i, j in traverse(rule, own, other, lambda i, j: (~found[rows[i]] | ~found[others[j]]) & (label[rows[i]] != label[others[j]])):
                found[rows[i]] = found[others[j]] = True
    lead, cell = (np.full(found.sum(), k.as_py()) for k in key)
    return pa.table({"lead": pa.array(lead, pa.int64()), "cell": pa.array(cell, pa.int32()), "mark": table["mark"].filter(pa.array(found)), "label": table["label"].filter(pa.array(found))})


def _bitmaps(each: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, bool]:
    """A bit for each shingle that two sets have; how many shingles of a set go without a bit of their own; whether none
    does. Shingles of one set only need no bit."""
    owner = np.repeat(np.arange(len(each)), [len(e) for e in each])
    _, of, count = np.unique(np.concatenate(each), return_inverse=True, return_counts=True)
    shared = count > 1
    bit = np.cumsum(shared) - 1
    use = shared[of]
    owner, bit = owner[use], bit[of[use]]
    most = max(64, BITMAP_BYTES * 8 // len(each) // 64 * 64)
    n_bits = max(64, -(-int(shared.sum()) // 64) * 64)
    out = np.zeros((len(each), min(n_bits, most) // 8), np.uint8)
    place = bit % (out.shape[1] * 8)
    np.bitwise_or.at(out, (owner, place >> 3), (1 << (place & 7)).astype(np.uint8))
    maps = out.view(np.uint64)
    return maps, np.bincount(owner, minlength=len(each)) - np.bitwise_count(maps).sum(1, dtype=np.int64), n_bits <= most


def _linked(rule: Rule, key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Links that connect all members of a cell that links connect, and that their labels don't."""
    mark, first = np.unique(table["mark"].to_numpy(), return_index=True)
    blobs, label = table["set"].to_pylist(), table["label"].to_numpy()[first]
    each = [_plain_set(blobs[k]) for k in first.tolist()]
    order = np.argsort([len(e) for e in each], kind="stable")
    each, mark, label = [each[k] for k in order.tolist()], mark[order], label[order]
    size = np.array([len(e) for e in each])
    maps, spare, exact = _bitmaps(each)
    _, root = np.unique(label, return_inverse=True)  # a label for each component so far
    found = []
    own = Tree(maps, size, spare)
    for i, j in traverse(rule, own, own, lambda i, j: root[i] != root[j]):
        for a, b in zip(i.tolist(), j.tolist()):
            if root[a] == root[b]:
                continue
            if not exact:
                at = np.minimum(np.searchsorted(each[b], each[a]), size[b] - 1)
                if not rule.links(int((each[b][at] == each[a]).sum()), int(size[a]), int(size[b])):
                    continue
            found.append((mark[a], mark[b]))
            root[root == root[b]] = root[a]
    a, b = zip(*found) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def links(docs: DataFrame, rule: Rule | None = None, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Memberships (id, n, mark: null for an empty set), and links (a, b) between marks that connect all that is linked."""
    members, found, _ = _links(docs, rule, id_col, text_col)
    return members, found


def _links(docs: DataFrame, rule: Rule | None, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """links(), and their components: where large groups needed those of the first links already, they are built on."""
    rule = rule or Rule()
    small_batches(docs.sparkSession)
    # key finds a document's text again; other rows with the same one do no harm.
    id_ = F.col(id_col).cast("long")
    texts = docs.select(id_.alias("id"), F.coalesce(id_, F.xxhash64(F.col(text_col))).alias("key"), F.col(text_col).alias("text"))
    members = cut(texts.mapInArrow(partial(_members, rule), "id long, key long, n long, mark long"))
    classes = members.where("mark IS NOT NULL").groupBy("mark").agg(F.min("key").alias("key"), F.first("n").alias("n"))
    shared = texts.sparkSession.sparkContext.broadcast(_frequent(texts, rule))
    n_rows, entries = members.agg(F.count(F.lit(1)), F.sum(F.when(F.col("mark").isNotNull(), F.col("n") - F.ceil(F.col("n") * rule.num / rule.den) + 1))).first()
    buckets = max(group_count(n_rows // BUCKET_GROUPS), -(-(entries or 0) // BUCKET_ENTRIES))
    blobs = texts.mapInArrow(partial(_prefixes, rule, shared, buckets), "b int, blob binary")
    blocks = blobs.groupBy("b").applyInArrow(_by_group(_blocks, rule), "lead long, part int, members binary")
    pairs = cut(blocks.groupBy("lead", "part").applyInArrow(_union, "lead long, mark long").distinct())

    large, told = _large(pairs)
    known = pairs.join(told(large), "lead", "left")
    strip = lambda n: F.pmod(F.xxhash64("mark"), F.col(n)).cast("int")
    cells = known.select("lead", F.coalesce(strip("strips"), F.lit(0)).alias("cell"), "mark")
    spread = lambda rows, n: rows.withColumn("cell", F.explode(F.sequence(F.lit(0), F.col(n) - 1)))
    pivots = spread(large.withColumn("mark", F.explode("pivots")), "strips").select("lead", "cell", "mark")
    found = _match(texts, classes, cells.unionByName(pivots).distinct().withColumn("label", F.col("mark")), rule)
    labels = components(found)
    if large.isEmpty():
        return members, found, labels
    inside = cut(pairs.join(told(large.drop("pivots")), "lead").join(labels.withColumnRenamed("node", "mark"), "mark", "left").withColumn("label", F.coalesce("component", "mark")))
    main = inside.groupBy("lead", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("lead").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.sum("c").alias("all"), F.max("c").alias("most"))
    rest = cut(main.where("all > most").select("lead", "main", F.ceil((F.col("all") - F.col("most")) / STRIP).cast("int").alias("others")))
    if rest.isEmpty():
        return members, found, labels
    every = inside.join(told(rest), "lead")
    # A cell is a strip of the members outside the main component and a strip of all members.
    left = spread(every.where("label <> main"), "strips").withColumn("cell", strip("others") * F.col("strips") + F.col("cell"))
    right = spread(every, "others").withColumn("cell", F.col("cell") * F.col("strips") + strip("strips"))
    both = left.unionByName(right).select("lead", F.col("cell").cast("int").alias("cell"), "mark", "label").distinct()
    more = _match(texts, classes, both, rule)
    stars = labels.where("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b"))
    return members, found.unionByName(more).distinct(), components(stars.unionByName(more))


def _large(pairs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Groups of more than STRIP members (lead, strips, pivots: the least members by some hashes), and how to join them."""
    salted = [F.min(F.struct(F.xxhash64(F.lit(i), "mark"), F.col("mark")))["mark"].alias(f"p{i}") for i in range(PIVOTS)]
    found = pairs.groupBy("lead").agg(F.ceil(F.count(F.lit(1)) / STRIP).cast("int").alias("strips"), *salted).where("strips > 1")
    large = cut(found.select("lead", "strips", F.array_distinct(F.array("lead", *[f"p{i}" for i in range(PIVOTS)])).alias("pivots")))
    return large, F.broadcast if large.count() <= TOLD_GROUPS else lambda rows: rows


def _match(texts: DataFrame, classes: DataFrame, cells: DataFrame, rule: Rule) -> DataFrame:
    """Links (a, b) between members of the same cells that have other labels, as many as connect what is linked."""
    cells, reps = cut(cells), classes.select("mark", "key")
    signatures = _describe(texts, reps, cells, rule, lambda keys: _signature(keys).tobytes(), "signature")
    known = signatures.join(classes.select("mark", "n"), "mark")
    promising = cut(cells.join(known, "mark").groupBy("lead", "cell").applyInArrow(_by_group(_promising, rule), "lead long, cell int, mark long, label long"))
    sets_ = _describe(texts, reps, promising, rule, _packed_set, "set")
    return cut(promising.join(sets_, "mark").groupBy("lead", "cell").applyInArrow(_by_group(_linked, rule), "a long, b long").distinct())


def _labels(members: DataFrame, known: DataFrame) -> DataFrame:
    """mark and label (one for all marks that links connect)."""
    marks = members.where("mark IS NOT NULL").select("mark").distinct()
    return marks.join(known.withColumnRenamed("node", "mark"), "mark", "left").select("mark", F.coalesce("component", "mark").alias("label"))


def group(docs: DataFrame, rule: Rule | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable by links) for every row of docs."""
    members, _, linked = _links(docs, rule, id_col, text_col)
    reps = members.where("mark IS NOT NULL").groupBy("mark").agg(F.min("id").alias("rep"))
    labels = reps.join(linked.withColumnRenamed("node", "mark"), "mark", "left").withColumn("label", F.coalesce("component", "mark"))
    names = labels.groupBy("label").agg(F.min("rep").alias("component_id"))
    known = labels.join(names, "label").select("mark", "component_id")
    out = members.join(known, "mark", "left")
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce(F.when(F.col("mark").isNotNull(), F.col("component_id")), F.col("id")).alias("component_id"))


def keep_one(docs: DataFrame, rule: Rule | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs' rows, one of each group of linked ones: that of the smallest id (null last), of rows with one id that of the
    smallest hash of all columns. Rows without words are in no group and stay. Equal rows are one."""
    first, second = free_name(docs, "row_h"), free_name(docs, "row_g")
    rows = docs.withColumns({first: row_hash(docs), second: row_hash(docs, 1)})
    has_words = F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    full = rows.where(has_words)
    # links() passes a row's hashes through as its id, so that its class comes back with the row, not with its id.
    named = full.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.col(first).alias("h"), F.col(second).alias("g"))
    members, _, linked = _links(named.select(F.col("h").alias("id"), "text"), rule, "id", "text")
    classes = members.where("mark IS NOT NULL").select(F.col("id").alias("h"), "mark").distinct()
    # The least row of each set, then of each group: no join has a key that copies share.
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h", "g")).alias("r")
    of_mark = named.select("id", "h", "g").distinct().join(classes, "h").groupBy("mark").agg(least)
    of_label = of_mark.join(_labels(members, linked), "mark").groupBy("label").agg(F.min("r").alias("r"))
    leaders = of_label.select(F.col("r.h").alias("leader_h"), F.col("r.g").alias("leader_g"))
    one = full.dropDuplicates([first, second]).join(leaders, (F.col(first) == F.col("leader_h")) & (F.col(second) == F.col("leader_g")), "left_semi")
    return one.unionByName(rows.where(~has_words)).select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ 	-
]+'), lambda x: x <> '') AS ws FROM documents
), sh AS (
  SELECT DISTINCT doc_id, hash(list_transform(ws[s:s + least(len(ws), 4) - 1], lambda x: x)) AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - least(len(ws), 4) + 2)) AS s FROM w WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
link AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM w
  UNION SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y
)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, (SELECT min(y) FROM reach WHERE reach.x = w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id)
"""
