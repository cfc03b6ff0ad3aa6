"""Lookups of cell values in dimensions: exact first, then approximate for what is left.

Results are rows with a status (ok, ambiguous, not_found), never exceptions. The approximate tier scores distinct values
only, against candidates that share a letter pair with one of the value's pieces: with k edits allowed, a value cut into
k + 1 pieces has one that occurs unchanged in any match, so blocking by the pieces' first letters loses none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspar.functions.fuzzy import Options, fuzzy_score
from loomspar.functions.repair import nfkc
from loomspar.functions.scalars import is_email, strip, strip_invisible

GAP = 0.1


def clean(c: Column | str) -> Column:
    return F.nullif(strip(strip_invisible(c)), F.lit(""))


def folded(c: Column | str) -> Column:
    """clean() under NFKC and without case. Only what isn't ASCII goes through Python; all else is null there."""
    c = F.col(c) if isinstance(c, str) else c
    return F.lower(clean(F.coalesce(nfkc(F.when(c.rlike(r"[^\x00-\x7F]"), c)), c)))


def resolve_unique(cells: DataFrame, dim: DataFrame, scope: list[str], keys: list[str] | None = None, fuzzy: Options | None = Options(), policy: str = "error") -> DataFrame:
    """cells (cell_id, value, scope columns) with status, id and score of the candidate that the value names.

    dim: scope columns, id, name, and any further keys. An exact hit equals the name, id or a key without case. policy:
    "error" makes several hits ambiguous, "first" takes the one with the least id."""
    keys = keys or []
    named = dim.where("name IS NOT NULL").withColumns({k: folded(F.col(k).cast("string")) for k in ["name", *keys]})
    wanted = cells.withColumn("wanted", folded("value"))
    exact_keys = F.array_distinct(F.array_compact(F.array(*[F.lower(F.col(k).cast("string")) for k in ["name", "id", *keys]])))
    exploded = named.select(*scope, "id", F.explode(exact_keys).alias("wanted"))
    hits = exploded.groupBy(*scope, "wanted").agg(F.min("id").alias("id"), F.countDistinct("id").alias("n"))
    out = wanted.join(hits, [*scope, "wanted"], "left")
    status = F.when(F.col("n") == 1, "ok").when(F.col("n") > 1, "ok" if policy == "first" else "ambiguous").otherwise("not_found")
    tier1 = out.select("cell_id", *scope, "wanted", status.alias("status"), F.when((status == "ok"), F.col("id")).alias("id"), F.when(F.col("n") >= 1, F.lit(0.0)).alias("score"))
    if fuzzy is None:
        return tier1.drop("wanted", *scope)
    miss = tier1.where("status = 'not_found' AND wanted IS NOT NULL").select(*scope, "wanted").distinct()
    near = _near(miss, named, scope, keys, fuzzy)
    both = tier1.join(near, [*scope, "wanted"], "left")
    late = (F.col("status") == "not_found") & F.col("best_id").isNotNull()
    second = F.when((F.col("close") > 1) & F.lit(policy == "error"), "ambiguous").otherwise("ok")
    return both.select(
        "cell_id", F.when(late, second).otherwise(F.col("status")).alias("status"), F.when(late, F.when(second == "ok", F.col("best_id"))).otherwise(F.col("id")).alias("id"), F.when(late, F.col("best")).otherwise(F.col("score")).alias("score")
    )


def _pairs_of(text: Column) -> Column:
    """All pairs of neighbouring letters."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(text) - 1, F.lit(1))), lambda i: F.substr(text, i, F.lit(2))))


def _pieces(text: Column, threshold: float) -> tuple[Column, Column]:
    """The edits allowed, and the letters in each of that many pieces and one."""
    n = F.least(F.char_length(text), F.lit(32))
    k = F.floor(n * threshold).cast("int")
    return k, F.greatest(F.floor(n / (k + 1)).cast("int"), F.lit(1))


def _piece_heads(text: Column, threshold: float) -> Column:
    """First letter pairs of the k + 1 pieces of each 32 letters, k edits being allowed."""
    k, size = _pieces(text, threshold)
    starts = F.flatten(F.transform(F.sequence(F.lit(0), F.floor((F.char_length(text) - 1) / 32).cast("int")), lambda c: F.transform(F.sequence(F.lit(0), k), lambda i: F.least(c * 32, F.greatest(F.char_length(text) - 32, F.lit(0))) + i * size + 1)))
    return F.array_distinct(F.transform(starts, lambda s: F.substr(text, s, F.lit(2))))


def scored(values: DataFrame, dim: DataFrame, scope: list[str], keys: list[str], o: Options) -> DataFrame:
    """wanted, scope, id, score: all matches of distinct values. Values whose pieces have a single letter, as many have at
    thresholds of 0.4 and more, can't be blocked by pairs: they are scored with all candidates of their scope (which must
    then bound them)."""
    low = lambda c: F.lower(F.col(c).cast("string"))
    own = dim.select(*scope, "id", "name", *keys)
    single = lambda n: n // (int(n * o.threshold) + 1) < 2
    short = _pieces(F.col("wanted"), o.threshold)[1] < 2
    heads = values.where(~short).select(*scope, "wanted", F.explode(_piece_heads(F.col("wanted"), o.threshold)).alias("gram"))
    grams = dim.select(*scope, "id", F.explode(F.array_distinct(F.flatten(F.array_compact(F.array(*[_pairs_of(low(k)) for k in ["name", *keys]]))))).alias("gram"))
    found = heads.join(grams, [*scope, "gram"]).select(*scope, "wanted", "id").distinct().join(own, [*scope, "id"])
    if any(single(n) for n in range(max(1, o.least_run), 33)):
        found = found.unionByName(values.where(short).select(*scope, "wanted").join(own, scope).select(*found.columns))
    return found.withColumn("score", fuzzy_score("wanted", "name", *keys, options=o)).where("score IS NOT NULL").select(*scope, "wanted", "id", "score")


def _near(values: DataFrame, dim: DataFrame, scope: list[str], keys: list[str], o: Options) -> DataFrame:
    hits = scored(values, dim, scope, keys, o)
    best = hits.groupBy(*scope, "wanted").agg(F.min(F.struct("score", "id")).alias("b"), F.sort_array(F.collect_list("score")).alias("s"))
    return best.select(*scope, "wanted", F.col("b.score").alias("best"), F.col("b.id").alias("best_id"), F.size(F.filter("s", lambda x: x - F.col("b.score") < GAP)).alias("close"))


def closest_names(names: DataFrame, candidates: DataFrame, scope: list[str], top: int = 3) -> DataFrame:
    """names (cell_id, scope, name) with the `top` candidates (scope, pos, candidate) nearest by edit distance."""
    pairs = names.join(candidates, scope).withColumn("distance", F.levenshtein(F.lower("name"), F.lower("candidate")))
    w = W.partitionBy("cell_id").orderBy("distance", "pos")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).select("cell_id", "rank", "candidate", "distance")


def field_by_name(names: DataFrame, fields: DataFrame, scope: list[str]) -> DataFrame:
    """cell_id, field_id, tier. fields: scope, pos, field_id, norm. Tier 1: equal (first field); 2: the only one of which
    one is a prefix of the other, at most 2 longer; 3: the only one that contains or is contained, for names of 5 letters
    or more and at most 4 longer."""
    own, norm = F.col("norm_name"), F.col("norm")
    gap = F.abs(F.length(own) - F.length(norm))
    prefix = (own.startswith(norm) | norm.startswith(own)) & (gap <= 2)
    inside = (own.contains(norm) | norm.contains(own)) & (F.length(own) >= 5) & (gap <= 4)
    tier = F.when(own == norm, 1).when(prefix, 2).when(inside, 3)
    values = names.select(*scope, "norm_name").distinct()
    pairs = values.join(fields, scope).withColumn("tier", tier).where("tier IS NOT NULL")
    # A field of a lower tier also counts in the higher ones it meets.
    met = pairs.withColumn("tiers", F.array_compact(F.array(F.when(own == norm, 1), F.when(prefix, 2), F.when(inside, 3)))).withColumn("tier", F.explode("tiers"))
    per = met.groupBy(*scope, "norm_name", "tier").agg(F.min_by("field_id", "pos").alias("field_id"), F.count(F.lit(1)).alias("n")).where("tier = 1 OR n = 1")
    best = per.groupBy(*scope, "norm_name").agg(F.min(F.struct("tier", "field_id")).alias("b"))
    return names.join(best, [*scope, "norm_name"], "left").select("cell_id", F.col("b.field_id").alias("field_id"), F.col("b.tier").alias("tier"))


# Tiers of users.


#: Letters by which parts of names are found, buckets of them, and most letters of a key.
HEAD, BUCKETS, KEY = 3, 1 << 16, 64
#: Similarity of a user's single names, by which the policy "score" ranks.
SIMILAR = Options(threshold=1.0, least_run=1)


def match_users(cells: DataFrame, users: DataFrame, policy: str = "first", fuzzy: Options | None = Options()) -> DataFrame:
    """cell_id, status, user_pos, confidence by tiers. users: pos, username, display, email, active.

    An e-mail is looked up among e-mails, then user names; other values stop at the first tier with a hit: equal user
    name (0.95), user name prefix (0.7), part of the display name (0.5). Values without a hit match users approximately
    (0.4) by all three, unless fuzzy is None. policy: first (in directory order, approximate ones by their score), error,
    or score (the most similar by the sum over the three, ambiguous if two are)."""
    if policy not in ("first", "error", "score"):
        raise ValueError(f"unknown policy {policy}")
    live = users.where("active IS NULL OR active").select("pos", "username", "display", "email").repartition("pos")  # small files make many keys
    some = F.col("value").rlike(r"(?U)[^\s\u00a0\u200b-\u200d\ufeff]")  # clean() leaves something
    wanted = cells.where(some).repartition("cell_id").withColumn("w", F.coalesce(F.lower(clean("value")), F.lit("")))
    values = wanted.select("w").distinct().withColumn("mail", is_email("w"))
    # Both sides grow, and what Spark expects of exploded rows is far too little: no side of these joins is broadcast.
    keys = _user_keys(values, live)
    able = F.when(F.col("mail"), F.col("tier") <= 2).otherwise(F.col("tier") >= 2)
    name, w = F.col("name"), F.col("w")
    whole = name.isNull() | F.when(F.col("tier") <= 2, name == w).when(F.col("tier") == 3, name.startswith(w)).otherwise(name.contains(w))
    confidence = F.element_at(F.array(*map(F.lit, (1.0, 0.95, 0.7, 0.5))), F.col("tier"))
    hits = values.hint("merge").join(keys, F.left("w", F.lit(KEY)) == F.col("k")).where(able & whole).select("w", "pos", confidence.alias("confidence"), "tier", F.lit(0.0).alias("s"))
    if fuzzy is not None:
        missed = values.hint("merge").join(hits.select("w").distinct(), "w", "left_anti").select(F.lit(1).alias("all"), F.col("w").alias("wanted"))
        near = scored(missed, live.select(F.lit(1).alias("all"), F.col("pos").alias("id"), F.col("display").alias("name"), "email", "username"), ["all"], ["email", "username"], fuzzy)
        hits = hits.unionByName(near.select(F.col("wanted").alias("w"), F.col("id").alias("pos"), F.lit(0.4).alias("confidence"), F.lit(5).alias("tier"), F.col("score").alias("s")))
    if policy == "score":
        return _most_similar(wanted, hits, live)
    top = hits.groupBy("w", "tier").agg(F.min(F.struct("s", "pos")).alias("f"), (F.min("pos") < F.max("pos")).alias("more"), F.first("confidence").alias("confidence"))
    best = top.groupBy("w").agg(F.min(F.struct("tier", F.col("f.pos").alias("pos"), "more", "confidence")).alias("b"))
    out = wanted.hint("merge").join(best, "w", "left")
    status = F.when(F.col("b").isNull(), "not_found").when(F.col("b.more") & F.lit(policy == "error"), "ambiguous").otherwise("ok")
    return out.select("cell_id", status.alias("status"), F.when(status == "ok", F.col("b.pos")).alias("user_pos"), F.when(status == "ok", F.col("b.confidence")).alias("confidence"))


def _user_keys(values: DataFrame, live: DataFrame) -> DataFrame:
    """k, tier, pos, name: all that a value can equal in a tier. Prefixes of user names and parts of display names are made
    only where a value begins with the same letters, and only in such values' lengths: what is known of the values is
    broadcast, at most BUCKETS rows of up to KEY lengths. Values of KEY letters and more share the key of their first ones;
    name is then what the whole value is compared with."""
    bucket = lambda head: F.pmod(F.xxhash64(head), F.lit(BUCKETS))
    named = lambda *tiers: live.select("pos", F.explode(F.array(*[F.struct(F.lit(t).alias("tier"), F.lower(c).alias("name")) for t, c in tiers])).alias("e")).select("pos", "e.*").where("name <> ''")
    heads = values.select(bucket(F.left("w", F.lit(HEAD))).alias("bucket"), F.least(F.char_length("w"), F.lit(KEY)).alias("n"), "mail").groupBy("bucket", "n").agg(F.bool_and("mail").alias("mails")).where("NOT mails").groupBy("bucket").agg(F.collect_list("n").alias("ns"))
    size = F.char_length("name")
    at = named((3, "username"), (4, "display")).withColumn("at", F.explode(F.sequence(F.lit(1), F.when(F.col("tier") == 3, 1).otherwise(size)))).withColumn("left", size - F.col("at") + 1)
    at = at.withColumn("h", F.explode(F.array(*map(F.lit, range(1, HEAD + 1))))).where("h <= left").withColumn("bucket", bucket(F.substring("name", F.col("at"), F.col("h"))))
    found = at.join(F.broadcast(heads), "bucket").select("pos", "tier", "name", "at", "h", "left", F.explode("ns").alias("n"))
    fits = (F.col("n") <= F.col("left")) & F.when(F.col("h") < HEAD, F.col("n") == F.col("h")).otherwise(F.col("n") >= HEAD)
    parts = found.where(fits).select(F.substring("name", F.col("at"), F.col("n")).alias("k"), "tier", "pos", "name")
    equal = named((1, "email"), (2, "username")).select(F.left("name", F.lit(KEY)).alias("k"), "tier", "pos", "name")
    return parts.unionByName(equal).withColumn("name", F.when(F.char_length("k") == KEY, F.col("name")))


def _most_similar(wanted: DataFrame, hits: DataFrame, live: DataFrame) -> DataFrame:
    """match_users() by the policy "score": of the first tier's hits; a name that is missing counts as not similar."""
    from loomspar.operators.entities import best_by_policy

    first = hits.groupBy("w").agg(F.min("tier").alias("tier"))
    pairs = hits.hint("merge").join(first, ["w", "tier"]).select("w", "pos", "confidence").distinct().hint("merge").join(live.select("pos", "username", "display", "email"), "pos")
    similarity = sum((F.coalesce(fuzzy_score("w", k, options=SIMILAR), F.lit(1.0)) for k in ("username", "display", "email")), F.lit(0.0))
    ranked = best_by_policy(pairs.withColumn("similarity", similarity).withColumnRenamed("w", "cell_id")).withColumnRenamed("cell_id", "w")
    sure = pairs.select("w", "pos", "confidence")
    out = wanted.hint("merge").join(ranked.hint("merge").join(sure, ["w", "pos"], "left"), "w", "left")
    return out.select("cell_id", F.coalesce("status", F.lit("not_found")).alias("status"), F.col("pos").alias("user_pos"), "confidence")


def user_payload(matched: DataFrame, users: DataFrame, deployment: str = "server") -> DataFrame:
    """cell_id and payload, {"accountId": ...} or {"name": ...} as JSON, of match_users()' rows; null without a user."""
    key, field = ("accountId", "account_id") if deployment == "cloud" else ("name", "username")
    known = users.select(F.col("pos").alias("user_pos"), F.to_json(F.struct(F.col(field).alias(key))).alias("payload"))
    return matched.join(known, "user_pos", "left").select("cell_id", "payload")


# Sprints, boards, parents.


def sprint_by_name(cells: DataFrame, sprints: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """cell_id, sprint_id: digits are an id; else an equal name (active before future before others, then position); else
    the only sprint whose name contains the value. scope: columns of both in which names are told apart."""
    scope = scope or []
    w = F.lower(clean("value"))
    state = F.when(F.lower("state") == "active", 0).when(F.lower("state") == "future", 1).otherwise(2)
    exact = sprints.groupBy(*scope, F.lower("name").alias("w")).agg(F.min_by("sprint_id", F.struct(state, "pos")).alias("equal_id"))
    own = cells.withColumn("w", w).join(exact, [*scope, "w"], "left")
    digits = F.col("w").rlike(r"^\d+$")
    missed = own.where(F.col("equal_id").isNull() & ~digits & F.col("w").isNotNull()).select(*scope, "w").distinct()
    named = sprints.select("sprint_id", F.lower("name").alias("n"), *[F.col(c).alias(f"__{c}") for c in scope])
    same = [F.col(c) == F.col(f"__{c}") for c in scope]
    parts = missed.join(named, [F.col("n").contains(F.col("w")), *same]).groupBy(*scope, "w").agg(F.min("sprint_id").alias("part_id"), F.count(F.lit(1)).alias("n")).where("n = 1")
    return own.join(parts, [*scope, "w"], "left").select("cell_id", F.coalesce(F.when(digits, F.col("w").try_cast("bigint")), "equal_id", "part_id").alias("sprint_id"))


def boards_by_hint(boards: DataFrame, hint: Column, top: int | None = None) -> DataFrame:
    """Boards in the order in which they are asked: recently used ones first, then the newest ids."""
    place = F.array_position(hint, F.col("board_id"))
    w = W.partitionBy("project").orderBy(F.when(place > 0, place).otherwise(F.lit(1 << 30)), F.col("board_id").desc())
    out = boards.withColumn("rank", F.row_number().over(w))
    return out if top is None else out.where(F.col("rank") <= top)


def used_board(hint: Column, board: Column, most: int = 5) -> Column:
    return F.slice(F.array_distinct(F.concat(F.array(board), hint)), 1, most)


def parent_weight(key: Column, summary: Column, project: Column, text: Column) -> Column:
    same, low, wanted = key.startswith(F.concat(project, F.lit("-"))), F.lower(summary), F.lower(text)
    return F.when(same, 100).otherwise(0) + F.when(low == wanted, 50).when(low.startswith(wanted), 25).otherwise(0)


def parent_field(fields: DataFrame, plugins: list[str], patterns: list[str]) -> DataFrame:
    """project, issue_type, field_id, name: the best field to hold a parent. Known plugins, then equal names, then names
    that contain a pattern, each in their given order; ties by name. Subtasks use the field "parent"."""
    low = F.lower(strip("name"))
    rank = F.lit(None).cast("int")
    for i, p in reversed(list(enumerate(patterns))):
        rank = F.when(low.contains(p), len(plugins) + len(patterns) + i).otherwise(rank)
    for i, p in reversed(list(enumerate(patterns))):
        rank = F.when(low == p, len(plugins) + i).otherwise(rank)
    for i, p in reversed(list(enumerate(plugins))):
        rank = F.when(F.col("plugin") == p, i).otherwise(rank)
    able = fields.where("kind = 'any'").withColumn("rank", rank).where("rank IS NOT NULL")
    best = able.groupBy("project", "issue_type").agg(F.min(F.struct("rank", "name", "field_id")).alias("b"))
    return best.select("project", "issue_type", F.col("b.field_id").alias("field_id"), F.col("b.name").alias("name"))


def parent_levels(levels: DataFrame) -> DataFrame:
    """type_id, level, parent_level: levels has id, title and type_ids."""
    own = levels.select(F.col("id").alias("level"), F.explode("type_ids").alias("type_id"))
    return own.join(levels.select(F.col("id").alias("parent_level")), F.col("parent_level") == F.col("level") + 1, "left").groupBy("type_id").agg(F.min_by(F.struct("level", "parent_level"), "level").alias("l")).select("type_id", "l.*")


def valid_parents(pairs: DataFrame, levels: DataFrame) -> DataFrame:
    """pairs (child_type, parent_type, further columns) with valid: the parent's type stands one level above the child's."""
    up = parent_levels(levels).select(F.col("type_id").alias("child_type"), "parent_level")
    types = levels.select(F.col("id").alias("parent_level"), F.explode("type_ids").alias("parent_type")).distinct().withColumn("valid", F.lit(True))
    out = pairs.join(up, "child_type", "left").join(types, ["parent_level", "parent_type"], "left")
    return out.withColumn("valid", F.coalesce("valid", F.lit(False))).drop("parent_level")


# Cascading options.


def resolve_cascade(cells: DataFrame, options: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """cell_id, status, parent_id, child_id by exact names. cells: cell_id, parent, child (either may be null). options:
    parent_id, parent, child_id, child. A lone value is a parent if it names one, else a child if one parent has it. scope:
    columns of both in which names are told apart."""
    scope = scope or []
    p, c = F.lower(clean("parent")), F.lower(clean("child"))
    own = cells.select("cell_id", *scope, p.alias("p"), c.alias("c"))
    parents = options.groupBy(*scope, F.lower("parent").alias("p")).agg(F.min("parent_id").alias("pid"))
    children = options.groupBy(*scope, F.lower("parent").alias("p"), F.lower("child").alias("c")).agg(F.min("child_id").alias("cid"))
    anywhere = options.groupBy(*scope, F.lower("child").alias("c")).agg(F.countDistinct("parent_id").alias("n"), F.min(F.struct("parent_id", "child_id")).alias("o"))
    full = own.where("p IS NOT NULL").join(parents, [*scope, "p"], "left").join(children, [*scope, "p", "c"], "left")
    full = full.select("cell_id", F.when(F.col("pid").isNull() | (F.col("c").isNotNull() & F.col("cid").isNull()), "not_found").otherwise("ok").alias("status"), F.col("pid").alias("parent_id"), F.col("cid").alias("child_id"))
    lone = own.where("p IS NULL").join(parents.withColumnRenamed("p", "c"), [*scope, "c"], "left").join(anywhere, [*scope, "c"], "left")
    is_parent = F.col("pid").isNotNull()
    lone = lone.select(
        "cell_id", F.when(is_parent, "ok").when(F.col("n") == 1, "ok").when(F.col("n") > 1, "ambiguous").otherwise("not_found").alias("status"),
        F.when(is_parent, F.col("pid")).when(F.col("n") == 1, F.col("o.parent_id")).alias("parent_id"), F.when(~is_parent & (F.col("n") == 1), F.col("o.child_id")).alias("child_id"),
    )
    ok = lambda name: F.when(F.col("status") == "ok", F.col(name)).alias(name)
    return full.unionByName(lone).select("cell_id", "status", ok("parent_id"), ok("child_id"))


def statuses(types: DataFrame, wanted: str | None = None) -> DataFrame:
    """id, name, issue_type: types has issue_type, pos and statuses (array of struct id, name); only those of the wanted
    type if it has any, each id once, the first kept."""
    rows = types.select("issue_type", "pos", F.posexplode("statuses").alias("at", "s"))
    if wanted is not None:
        hit = F.lower("issue_type") == F.lower(F.lit(wanted))
        some = rows.where(hit).agg((F.count(F.lit(1)) > 0).alias("some"))
        rows = rows.join(some, ~F.col("some") | hit).drop("some")
    return rows.groupBy(F.col("s.id").alias("id")).agg(F.min_by(F.struct(F.col("s.name").alias("name"), "issue_type"), F.struct("pos", "at")).alias("f")).select("id", "f.*")
