"""Sharding by histogram sort, in DataFrame operations only, with the law `bytes`: shards of near equal size.

Rows are ordered by the hash of their text, then by that of their id. Splitters of this order are found by probing: exact
bytes are counted below each candidate key across all partitions, a byte of the key more in each round, and only for the
slices that hold a splitter, until each splitter is within TOLERANCE of its target. Then rows are exchanged once, to the
partition that the splitters name, and sorted there; partitions follow each other by shard, then by key, so a shard is a
run of partitions and a row's slot is its place in its partition after the rows before it.

Rows of one text stay together in one shard. Texts whose rows weigh more than HEAVY of a shard together are placed first,
the heaviest first, each into the shard with the most room, and the rest of the order is cut at what room is left. Only
where no shard has room for a text's rows are they split by their ids, as `bytes` holds above all.

A partition has about PART_BYTES, or a MAX_PARTS-th of all if that is more. Only these come to the driver: a row a splitter
and round, a row a heavy text (at most shards / HEAVY), a row a stretch of the order between splitters and heavy texts.

Defined cases: a null text counts as an empty one; repeated rows share a key and stay in one shard; an empty table has
no rows; fewer texts than shards leave shards empty; any number of shards will do. Other columns stay as they are.
"""

from __future__ import annotations

import heapq
import json
from bisect import bisect_left

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspar.llm._lineage import cut
from loomspar.llm._rows import free_name

SHARDS = 8
#: Shares of a shard's target.
TOLERANCE, HEAVY = 0.005, 0.04
PART_BYTES, MAX_PARTS = 64 << 20, 1 << 16
_SIGN, _END = 1 << 63, 1 << 128
_LOW = (1 << 64) - 1


class Keys:
    """Columns that a row is sharded by: 64-bit hashes of text and id, and the row's weight."""

    def __init__(self, id_col: str, text_col: str) -> None:
        text = F.coalesce(F.col(text_col), F.lit(""))
        self.h, self.d = F.xxhash64(text), F.xxhash64(F.lit(1), F.col(id_col))
        self.size = (F.octet_length(text) + 1).cast("long")
        self.crc = F.crc32(text.cast("binary"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= _SIGN else x


def _flip(x: Column) -> Column:
    """Unsigned order as signed order."""
    return x.bitwiseXOR(F.lit(-_SIGN))


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of the driver's, as a literal of the plan."""
    names = [c.split()[0] for c in schema.split(", ")]
    kind = "array<struct<" + ",".join(f"{n}:{c.split()[1]}" for n, c in zip(names, schema.split(", "))) + ">>"
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps([dict(zip(names, r)) for r in rows])), kind)).alias("r")).select("r.*")


def _slice(level: int) -> tuple[Column, Column]:
    """The first `level` bytes of a row's key, those of h and those of d."""
    above = F.lit(0).cast("long") if level == 0 else F.shiftrightunsigned("h", 64 - 8 * level) if level < 8 else F.col("h")
    return above, F.shiftrightunsigned("d", 128 - 8 * level) if level > 8 else F.lit(0).cast("long")


def splitters(keys: DataFrame, targets: list[float], slack: float, levels: int = 16) -> list[int]:
    """For each target (ascending weights) the first 128-bit key from which on rows lie beyond it. The weight below a
    splitter is within slack of its target, if no single key (of the first `levels` bytes; 8 keep texts whole) weighs more.
    keys: h, d and w (weight)."""
    spark = keys.sparkSession
    found: dict[int, int] = {}
    #: By splitter: the first bytes of the slice that it lies in, and the weight below that.
    open_ = dict.fromkeys(range(len(targets)), (0, 0))
    for level in range(levels):
        if not open_:
            break
        slices = {p: i for i, p in enumerate(sorted({p for p, _ in open_.values()}))}
        n_low = max(0, 8 * (level - 8))
        about = _table(spark, [(_signed(p >> n_low), p & ((1 << n_low) - 1), i) for p, i in slices.items()], "above long, under long, i int")
        asked = _table(spark, [(slices[p], j, float(targets[j] - below)) for j, (p, below) in open_.items()], "i int, j int, rest double")
        above, under = _slice(level)
        digit = F.shiftrightunsigned("h" if level < 8 else "d", 56 - 8 * (level % 8)).bitwiseAND(F.lit(255)).cast("int")
        inside = keys.select(above.alias("above"), under.alias("under"), digit.alias("b"), "w").join(F.broadcast(about), ["above", "under"])
        sums = inside.groupBy("i", "b").agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n"))
        sums = sums.withColumn("upto", F.sum("w").over(W.partitionBy("i").orderBy("b")))  # 256 rows a slice at most
        at = F.struct("b", "upto", "w", "n")
        hits = asked.join(sums, "i").groupBy("j").agg(F.coalesce(F.min(F.when(F.col("upto") > F.col("rest"), at)), F.max(at)).alias("at"))
        rows = hits.collect()
        if not rows:
            break
        for j, (b, upto, w, n) in rows:
            prefix, below = open_.pop(j)
            first, rest = prefix << 8 | b, targets[j] - below
            if n == 1 or w <= slack or level == levels - 1:
                found[j] = (first + (rest - (upto - w) > upto - rest)) << 8 * (15 - level)
            else:
                open_[j] = (first, below + upto - w)
    return [min(found.get(j, _END - 1), _END - 1) for j in range(len(targets))]


def place_of(h: Column, d: Column, first: list[int]) -> Column:
    """How many of the sorted keys `first` are at or below a row's key, less one: bisection in two literal arrays."""
    flipped = lambda x: _signed((x ^ _SIGN) & _LOW)
    high, low = (F.from_json(F.lit(json.dumps([flipped(x) for x in part])), "array<long>") for part in ([k >> 64 for k in first], [k & _LOW for k in first]))
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(first).bit_length()))])
    key = F.struct(_flip(h).alias("h"), _flip(d).alias("d"))

    def step(at: Column, n: Column) -> Column:
        to = at["p"] + n
        a, b, k = F.get(high, to), F.get(low, to), at["k"]
        under = (to < len(first)) & ((a < k["h"]) | ((a == k["h"]) & (b <= k["d"])))
        return F.struct(F.when(under, to).otherwise(at["p"]).alias("p"), k.alias("k"))

    return F.aggregate(steps, F.struct(F.lit(-1).alias("p"), key.alias("k")), step, lambda at: at["p"])


def _part(total: int) -> float:
    return max(PART_BYTES, total / MAX_PARTS)


def _rooms(heavy: list[tuple[int, int]], share: float, shards: int) -> tuple[dict[int, int], dict[int, list[tuple[int, float]]], list[float]]:
    """Heavy texts' shards, the split ones' shards with what each takes, and the room left."""
    room = [share] * shards
    whole: dict[int, int] = {}
    split: dict[int, list[tuple[int, float]]] = {}
    heap = [(-share, s) for s in range(shards)]
    for h, w in sorted(heavy, key=lambda x: (-x[1], x[0])):
        rest = float(w)
        while rest > 0 and (room[heap[0][1]] > 0 or not split.get(h)):
            s = heap[0][1]
            if h not in split and w <= room[s] + TOLERANCE * share:
                whole[h], part = s, rest
            else:
                part = min(rest, max(room[s], 0.0))
                split.setdefault(h, []).append((s, part))
            room[s] -= part
            rest -= part
            heapq.heapreplace(heap, (-room[s], s))
    return whole, split, [max(0.0, r) for r in room]


def segments(compact: DataFrame, shards: int) -> list[tuple[int, int]]:
    """First key and shard of every segment of the order."""
    total = compact.agg(F.sum("w")).first()[0] or 0
    if not total:
        return [(0, 0)]
    share, part = total / shards, _part(total)
    found = compact.groupBy("h").agg(F.sum("w").alias("w")).where(F.col("w") > HEAVY * share).collect()  # at most shards / HEAVY
    whole, split, room = _rooms([(r.h & _LOW, r.w) for r in found], share, shards)
    weight = {r.h & _LOW: r.w for r in found}
    known = _table(compact.sparkSession, [(_signed(h), h in split) for h in weight], "h long, split boolean")

    light = compact.join(F.broadcast(known.select("h")), "h", "left_anti") if weight else compact
    targets, owner, at = [], [], 0.0
    for s, r in enumerate(room):
        n = max(1, round(r / part)) if r else 0
        targets += [at + r * i / n for i in range(n)]
        owner += [s] * n
        at += r
    starts = dict(zip([0, *splitters(light, targets[1:], TOLERANCE * min(share, 10 * part), 8)], owner)) if targets else {0: 0}
    if split:
        asked, at = [], 0.0
        for h in sorted(split):
            upto = at
            for s, size in split[h]:
                n = max(1, round(size / part))
                asked += [(h, s, upto + size * i / n) for i in range(n)]
                upto += size
            at += weight[h]
        pieces = compact.join(F.broadcast(known.where("split").select("h")), "h", "left_semi")
        cuts = splitters(pieces, [t for _, _, t in asked], TOLERANCE * min(share, 10 * part))
    groups = [(h << 64, [(h << 64 | i * (1 << 64) // n, s) for n in [max(1, round(weight[h] / part))] for i in range(n)]) for h, s in whole.items()]
    if split:
        its_cuts: dict[int, list[tuple[int, int]]] = {}
        for (h, s, _), key in zip(asked, cuts):
            its_cuts.setdefault(h, []).append((max(h << 64, min(key, (h << 64) + _LOW)) if h in its_cuts else h << 64, s))
        groups += [(h << 64, its) for h, its in its_cuts.items()]
    light_starts, light_keys = dict(starts), sorted(starts)
    for begin, its in sorted(groups):
        end = begin + (1 << 64)
        lo, hi = bisect_left(light_keys, begin), bisect_left(light_keys, end)
        for key in light_keys[lo:hi]:
            starts.pop(key, None)
        starts |= dict(its)
        if end < _END:
            starts.setdefault(end, light_starts[light_keys[hi - 1]])
    return sorted(starts.items())


def _partitions(plan: list[tuple[int, int]], size: dict[int, tuple[int, int]], part: float) -> tuple[list[int], list[int], list[int]]:
    """By segment its partition; by partition its shard and the rows of the shard before it. size: bytes and rows of the
    segments that have any. Segments of one shard share a partition of about `part` bytes."""
    number, shard, before = [0] * len(plan), [], []
    held, upto = 0, 0
    for i in sorted(range(len(plan)), key=lambda i: (plan[i][1], i)):
        w, n = size.get(i, (0, 0))
        if not shard or shard[-1] != plan[i][1] or (held and held + w > 1.25 * part):
            upto = upto if shard and shard[-1] == plan[i][1] else 0
            shard.append(plan[i][1])
            before.append(upto)
            held = 0
        number[i] = len(shard) - 1
        held += w
        upto += n
    return number, shard, before


def assign(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """docs with the columns size, text_crc32, shard and slot under names that docs doesn't have (see the dict), dealt out
    and sorted by shard and key."""
    k = Keys(id_col, text_col)
    compact = cut(docs.select(k.h.alias("h"), k.d.alias("d"), k.size.alias("w")))
    plan = segments(compact, shards)
    first = [key for key, _ in plan]
    rows = compact.groupBy(place_of(F.col("h"), F.col("d"), first).alias("p")).agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n")).collect()  # a row a segment
    number, shard, before = _partitions(plan, {r.p: (r.w, r.n) for r in rows}, _part(sum(r.w for r in rows)))
    names, taken = {}, docs
    for name in ("size", "text_crc32", "shard", "slot", "h", "d", "part"):
        names[name] = free_name(taken, name)
        taken = taken.withColumn(names[name], F.lit(None))
    h, d, part = F.col(names["h"]), F.col(names["d"]), F.col(names["part"])
    of = lambda values, at, kind: F.get(F.from_json(F.lit(json.dumps(values)), f"array<{kind}>"), at)
    full = docs.withColumns({names["h"]: k.h, names["d"]: k.d, names["size"]: k.size, names["text_crc32"]: k.crc})
    full = full.withColumn(names["part"], of(number, place_of(h, d, first), "int"))
    dealt = full.repartitionById(len(shard), part).sortWithinPartitions(part, _flip(h), _flip(d), F.col(id_col))
    nth = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # a row's place in its partition
    dealt = dealt.withColumn(names["slot"], nth)
    dealt = dealt.withColumns({names["shard"]: of(shard, part, "int"), names["slot"]: (F.col(names["slot"]) + of(before, part, "long")).cast("long")})
    return dealt.drop(names["h"], names["d"], names["part"]), {x: names[x] for x in ("size", "text_crc32", "shard", "slot")}


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out, c = assign(docs)
    return out.select(
        "doc_id", F.col(c["size"]).alias("size"), F.col(c["text_crc32"]).alias("text_crc32"), F.lit("bytes").alias("law"), F.col(c["shard"]).alias("shard"), F.col(c["slot"]).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
