"""Mixing sources to target weights, in DataFrame operations only.

Sources in code point order (null last) weigh 1, 2, 3, repeating. Targets share all words by weight; a source gives at
most MAX_PASSES times its words, and what it can't give is shared by weight among the rest, until none is above.

A source's documents, in the order of their hashes, form one stream of words, packed into blocks of BLOCK words. The mix is
cut into shards of SHARD_SLOTS slots, one block each. The counts of sources in a shard are a multinomial draw: every slot
draws a source by its own hash. Over all shards a source may so come out above or below its target's blocks; of those
above, as many draws as are too many, picked by a permutation of its draws, are handed to those below. So totals are exact
to a block and the counts of a shard vary as draws without replacement do.

A source's draws are numbered, and number j takes the block that the permutation of pass j div n gives for j mod n, with n
blocks: a keyed Feistel network over a x b >= n cells, walked until the result is below n. So every block is taken once
before any is taken again, and none more than MAX_PASSES times. Drawn blocks are joined to the blocks' word spans by
(source, index). All draws come from hashes: reruns agree.

Places in the streams are prefix sums over small hashed chunks of a source, so that no task orders a whole source. What one
task does hold is one row a source (targets), or one row a shard of a source (numbering the draws).

Defined cases: a null or empty text has size 0 and is taken 0 times; repeated rows follow each other in the stream and
count apiece; an empty table has no rows; other columns are ignored, of any type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspar.llm._lineage import cut
from loomspar.llm._rows import free_name, row_hash

BLOCK = 64
MAX_PASSES = 3
WEIGHTS = (1, 2, 3)
SHARD_SLOTS = 65536
CHUNK_ROWS = 512
SEED = 17
#: Rounds of the Feistel network, and how often its result is put in again while outside. There are less than a results
#: outside, of a * b with a the root of n: with a <= WALKS one is found surely, else but for a chance under a ** -WALKS.
ROUNDS, WALKS = 6, 32
#: Draws made in one task, on average, and the most tasks that they are dealt to.
TASK_DRAWS, TASKS = 1 << 14, 20000
#: Tables with a row a source are told to the executors up to this number of sources, else joined.
TOLD_SOURCES = 1 << 17


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _uniform(*of: Column) -> Column:
    """A number in [0, 1) that depends on the arguments only."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *of), 11).cast("double") / F.lit(float(1 << 53))


def _div(x: Column, n: Column) -> Column:
    return ((x - F.pmod(x, n)) / n).cast("long")


def permuted(x: Column, n: Column, *key: Column) -> Column:
    """A pseudorandom permutation of 0 .. n - 1, another for each key, applied to x."""
    x, n = x.cast("long"), n.cast("long")
    a = F.ceil(F.sqrt(n)).cast("long")
    b = _div(n + a - 1, a)

    def once(y: Column) -> Column:
        by = lambda i, other: F.shiftright(F.xxhash64(F.lit(SEED), *key, i, other), 2)

        def turn(s: Column, i: Column) -> Column:
            left = F.array(F.pmod(s["l"] + by(i, s["r"]), a))
            return F.get(F.transform(left, lambda x: F.struct(x.alias("l"), F.pmod(s["r"] + by(i + 1, x), b).alias("r"))), F.lit(0))

        return F.aggregate(F.array(*map(F.lit, range(0, ROUNDS, 2))), F.struct(F.pmod(y, a).alias("l"), _div(y, a).alias("r")), turn, lambda s: s["r"] * a + s["l"])

    walked = lambda y: F.aggregate(F.array(*map(F.lit, range(WALKS))), y, lambda z, _: F.when(z < n, z).otherwise(once(z)))
    # An array of one, so that the first result is computed once and the walk only where it is outside.
    return F.get(F.transform(F.array(once(x)), lambda y: F.when(y < n, y).otherwise(walked(y))), F.lit(0))


def targets(sizes: DataFrame) -> DataFrame:
    """From source and source_size: also rank, n_blocks and target. A source is capped if, of those with as little room
    for their weight or less, all before it are; the rest share what is left by weight."""
    by_source = W.orderBy(F.col("source").asc_nulls_last())
    out = sizes.withColumn("rank", F.row_number().over(by_source).cast("int"))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), F.pmod(F.col("rank") - 1, F.lit(len(WEIGHTS))) + 1).cast("double")
    cap = F.col("source_size").cast("double") * MAX_PASSES
    out = out.withColumns({"weight": weight, "cap": cap, "room": cap / weight})
    by_room, everything = W.orderBy("room", "rank"), W.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(by_room.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    level = left / F.sum("weight").over(by_room.rowsBetween(0, W.unboundedFollowing))
    out = out.withColumn("level", level)
    free = F.min(F.when(F.col("level") <= F.col("room"), F.struct("room", "rank", "level"))).over(everything)
    target = F.least(F.col("cap"), F.coalesce(free["level"], F.lit(float("inf"))) * F.col("weight"))
    blocks = F.ceil(F.col("source_size") / BLOCK).cast("long")
    return out.select("rank", "source", "source_size", target.alias("target"), blocks.alias("n_blocks"))


def placed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """Documents (id, size, rank, source_size, target, begin: the first word's place in its source's stream), and sources."""
    text = F.col(text_col)
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"), word_count(text).alias("size"), F.xxhash64(id_col, source_col, text_col).alias("h"))
    base = cut(base)
    chunks = max(1, base.count() // CHUNK_ROWS)
    sources = cut(targets(base.groupBy("source").agg(F.sum("size").alias("source_size"))))
    rows = base.withColumn("chunk", F.pmod("h", F.lit(chunks)).cast("int"))
    known = sources.withColumnRenamed("source", "s")
    rows = rows.join(known, F.col("source").eqNullSafe(F.col("s"))).drop("s", "source")
    sums = rows.groupBy("rank", "chunk").agg(F.sum("size").alias("n"))
    before = W.partitionBy("rank").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select("rank", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = W.partitionBy("rank", "chunk").orderBy("h", "id", "size").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.join(starts, ["rank", "chunk"])
    begin = (F.col("start") + F.coalesce(F.sum("size").over(within), F.lit(0))).alias("begin")
    return rows.select("id", "h", "size", "rank", "source_size", "target", begin), sources


def counts(sources: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Multinomial draws of every shard's slots (shard, rank, n); the sources' books (rank, n_blocks, the blocks wanted over
    all shards, and their stretch low to high of all slots); and the number of slots."""
    live = sources.where("n_blocks > 0").withColumn("expected", F.col("n_blocks") * F.col("target") / F.col("source_size"))
    upto = W.orderBy("rank")
    live = live.withColumn("high", F.round(F.sum("expected").over(upto.rowsBetween(W.unboundedPreceding, 0))).cast("long"))
    live = live.withColumn("low", F.coalesce(F.lag("high").over(upto), F.lit(0).cast("long")))
    # Rounding may ask for a block more than the passes have.
    wanted = F.least(F.col("high") - F.col("low"), F.col("n_blocks") * MAX_PASSES).alias("wanted")
    live = cut(live.select("rank", "n_blocks", "low", "high", wanted))
    total = live.agg(F.max("high")).first()[0] or 0
    # A slot falls at a random place of 0 .. total, in one of the few stretches that touch the place's cell.
    width = F.lit(max(1, -(-total // 1024)))
    cell = lambda x: _div(x.cast("long"), width)
    stretches = live.where("high > low").withColumn("cell", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high") - 1)))).select("rank", "low", "high", "cell")
    slots = live.sparkSession.range(0, total, 1, max(1, min(TASKS, -(-total // (16 * TASK_DRAWS)))))
    place = F.least(F.floor(_uniform(F.lit("slot"), F.col("id")) * total).cast("long"), F.lit(total - 1))
    drawn = slots.select(_div(F.col("id"), F.lit(SHARD_SLOTS)).alias("shard"), place.alias("place")).withColumn("cell", cell(F.col("place")))
    found = drawn.join(_told(stretches), "cell").where("place >= low AND place < high")
    return found.groupBy("shard", "rank").agg(F.count(F.lit(1)).alias("n")), live, total


def _told(by_source: DataFrame) -> DataFrame:
    return F.broadcast(by_source) if by_source.count() <= TOLD_SOURCES else by_source


def draws(sources: DataFrame) -> DataFrame:
    """shard, slot, rank, block: which block of which source fills each slot of each output shard."""
    cells, live, total = counts(sources)
    cells = cut(cells)
    upto = W.orderBy("rank").rowsBetween(W.unboundedPreceding, -1)
    book = live.join(cells.groupBy("rank").agg(F.sum("n").alias("drawn")), "rank", "left").select("rank", "n_blocks", "wanted", F.coalesce("drawn", F.lit(0)).alias("drawn"))
    book = book.withColumns({"surplus": F.greatest(F.col("drawn") - F.col("wanted"), F.lit(0)), "lack": F.greatest(F.col("wanted") - F.col("drawn"), F.lit(0))})
    book = cut(book.withColumns({"given": F.coalesce(F.sum("surplus").over(upto), F.lit(0)), "got": F.coalesce(F.sum("lack").over(upto), F.lit(0))}))
    handed = book.agg(F.sum("surplus")).first()[0] or 0
    low = F.coalesce(F.sum("n").over(W.partitionBy("shard").orderBy("rank").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    first = F.coalesce(F.sum("n").over(W.partitionBy("rank").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    cells = cells.withColumns({"low": low, "first": first}).join(_told(book), "rank")
    tasks = max(1, min(TASKS, -(-total // TASK_DRAWS)))

    def each(of: DataFrame) -> DataFrame:
        """A row a draw. A cell becomes up to SHARD_SLOTS rows, so the few cells are dealt out first, to a set number of tasks."""
        out = of.repartition(tasks, "shard", "rank").withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
        own = F.col("first") + F.col("k")
        return out.withColumns({"slot": F.col("low") + F.col("k"), "p": F.when(F.col("surplus") > 0, permuted(own, F.col("drawn"), F.lit("kept"), F.col("rank"))).otherwise(own)})

    kept = each(cells).where("p >= surplus").select("shard", "slot", "rank", "n_blocks", (F.col("p") - F.col("surplus")).alias("number"))
    if handed:
        spare = each(cells.where("surplus > 0")).where("p < surplus").select("shard", "slot", permuted(F.col("given") + F.col("p"), F.lit(handed), F.lit("handed")).alias("place"))
        taken = book.where("lack > 0").withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lack") - 1)))
        taken = taken.select((F.col("got") + F.col("i")).alias("place"), "rank", "n_blocks", (F.col("drawn") + F.col("i")).alias("number"))
        kept = kept.unionByName(spare.join(taken, "place").drop("place"))
    turn = _div(F.col("number"), F.col("n_blocks"))
    block = permuted(F.pmod("number", "n_blocks"), F.col("n_blocks"), F.lit("block"), F.col("rank"), turn)
    return kept.select("shard", "slot", "rank", block.alias("block"))


def spans(rows: DataFrame) -> DataFrame:
    """The blocks that each document's words fall in: the columns of rows, block, start and end (words of the document)."""
    last = F.floor((F.col("begin") + F.col("size") - 1) / BLOCK)
    out = rows.where("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("begin") / BLOCK), last)))
    start = F.greatest(F.lit(0).cast("long"), F.col("block") * BLOCK - F.col("begin"))
    end = F.least(F.col("size"), (F.col("block") + 1) * BLOCK - F.col("begin"))
    return out.withColumns({"start": start, "end": end})


def mixed_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: for each slot of each shard, the documents' word spans that fill it."""
    rows, sources = placed(docs, id_col, text_col, source_col)
    return draws(sources).hint("merge").join(spans(rows), ["rank", "block"]).select("shard", "slot", "rank", "block", "id", "start", "end")


def taken_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """id, h (hash of id, source and text), size, source_size, target, taken (words, repeats counted), and the spans taken
    with their numbers of uses."""
    rows, sources = placed(docs, id_col, text_col, source_col)
    rows = cut(rows)
    # Cut, as a plan with the draws in it is planned again after each of its exchanges, by the driver.
    uses = cut(draws(sources).groupBy("rank", "block").agg(F.count(F.lit(1)).alias("uses")))
    # A row that has words is the only such row at its place in the stream.
    taken = spans(rows).join(uses.hint("merge"), ["rank", "block"]).groupBy("rank", "begin").agg(
        F.sum((F.col("end") - F.col("start")) * F.col("uses")).alias("t"), F.array_sort(F.collect_list(F.struct("start", "end", "uses"))).alias("s")
    )
    out = rows.join(taken, ["rank", "begin"], "left")
    full = F.col("size") > 0
    return out.select("id", "h", "size", "source_size", "target", F.coalesce(F.when(full, F.col("t")), F.lit(0)).cast("long").alias("taken"), F.when(full, F.col("s")).alias("spans"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """docs as the mix has them: for each time that a document's words are taken, a row with the words taken in that
    pass, joined by one space, as its text (and their number of characters as n_chars, if there is such a column)."""
    names = {x: free_name(docs, f"mix_{x}") for x in ("h", "spans", "pass", "words", "nth", "row", "same")}
    taken = taken_words(docs, id_col, text_col, source_col).where("taken > 0")
    # Rows of one id, source and text are alike to the mix; each gets one of the results.
    taken = taken.select(F.col("h").alias(names["h"]), F.col("spans").alias(names["spans"]), F.row_number().over(W.partitionBy("h").orderBy("spans")).alias(names["nth"]))
    full = docs.withColumn(names["same"], F.xxhash64(id_col, source_col, text_col))
    full = full.withColumn(names["row"], F.row_number().over(W.partitionBy(names["same"]).orderBy(row_hash(docs))))
    both = full.join(taken, (F.col(names["same"]) == F.col(names["h"])) & (F.col(names["row"]) == F.col(names["nth"])))
    most = F.array_max(F.transform(names["spans"], lambda s: s["uses"])).cast("int")
    # The words are split below the explode: there they are a column, above it they would be split again for each span.
    words = F.filter(F.split(F.col(text_col), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    both = both.withColumn(names["words"], words).withColumn(names["pass"], F.explode(F.sequence(F.lit(1), most)))
    pieces = F.transform(F.filter(names["spans"], lambda s: s["uses"] >= F.col(names["pass"])), lambda s: F.array_join(F.slice(names["words"], (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")), " "))
    out = both.withColumn(text_col, F.array_join(pieces, " "))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length(text_col).cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return taken_words(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")
