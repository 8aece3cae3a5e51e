"""Sharding by balanced label propagation.

Documents with equal texts are linked. All documents start dealt evenly; then linked
documents move, round by round, to the shard that holds most of their neighbours, as far
as quotas allow. Shards end with row counts at most one apart.

The state is one row per group and shard with a count, since members of a group are
interchangeable: a group with a third of all rows is as many rows as there are shards.
Moves from shard a to b are limited to the moves wanted from b to a, which keep sizes,
plus a share of the room in b; whom the limit meets is set by a hash, and a group at the
limit moves in part. Documents with no link move last, to fill what is left.

Null texts count as empty. Rows that repeat are rows of their own. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlens.llm.common import ranked, stored

ROUNDS = 4


def _quotas(rows: int, shards: int) -> list[int]:
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def _wanted(state: DataFrame) -> DataFrame:
    """``state`` with ``best``, the shard with most of the group's documents."""
    order = Window.partitionBy("group").orderBy(F.desc("n"), F.xxhash64("group", "shard"), "shard")
    return state.withColumn("best", F.first("shard").over(order))


def _limits(asked: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many documents may go from a to b."""
    allowed = {}
    for (a, b), n in asked.items():
        swap = min(n, asked.get((b, a), 0))
        others = sum(x - min(x, asked.get((b, c), 0)) for (c, to), x in asked.items() if to == b)
        rest = n - swap
        allowed[a, b] = swap + (min(rest, max(0, room[b]) * rest // others) if others else 0)
    return allowed


def propagate(state: DataFrame, shards: int, quotas: list[int], rounds: int) -> DataFrame:
    """``state`` (group, shard, n) after some rounds of moves; it is stored after each."""
    spark = state.sparkSession
    for _ in range(rounds):
        wish = _wanted(state)
        # At most one row for each pair of shards.
        flows = wish.groupBy("shard", "best").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).collect()
        held = [sum(row.n for row in flows if row.shard == shard) for shard in range(shards)]
        asked = {(row.shard, row.best): row.n for row in flows if row.shard != row.best}
        allowed = {k: v for k, v in _limits(asked, [q - h for q, h in zip(quotas, held)]).items() if v}
        if not allowed:
            break
        limits = spark.createDataFrame([(a, b, n) for (a, b), n in allowed.items()], "shard int, best int, most long")
        parts = max(1, sum(row.rows for row in flows) // 20_000)
        movers = wish.filter("shard <> best").withColumn("part", F.expr(f"pmod(xxhash64(group), {parts})"))
        keys = ["shard", "best", "part"]
        before = Window.partitionBy("shard", "best").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        starts = (
            movers.groupBy(*keys)
            .agg(F.sum("n").alias("total"))
            .withColumn("start", F.coalesce(F.sum("total").over(before), F.lit(0)))
            .drop("total")
        )
        inside = Window.partitionBy(*keys).orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
        going = (
            movers.withColumn("ahead", F.coalesce(F.sum("n").over(inside), F.lit(0)))
            .join(starts, keys)
            .join(F.broadcast(limits), ["shard", "best"])
            .withColumn("go", F.expr("greatest(0, least(n, most - start - ahead))"))
            .filter("go > 0")
        )
        moved = going.selectExpr("group", "explode(array(struct(shard, -go as n), struct(best as shard, go as n))) as x")
        state = stored(
            state.unionByName(moved.selectExpr("group", "x.shard", "x.n"))
            .groupBy("group", "shard")
            .agg(F.sum("n").alias("n"))
            .filter("n > 0")
        )
    return state


def _by_place(bounds: list[int], place: str, shards: range) -> str:
    """SQL for the shard whose part of a row of places holds ``place``."""
    cases, end = [], 0
    for shard, n in zip(shards, bounds):
        end += n
        cases.append(f"when {place} < {end} then {shard}")
    return f"case {' '.join(cases)} end"


def sharded(docs: DataFrame, shards: int = 16, rounds: int = ROUNDS, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row per document: the id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and
    ``grown_shard`` (null: counts, not keys, decide), and ``group_rows``, the documents with its text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = stored(
        docs.select(
            F.col(id_column).alias("doc_id"),
            (F.octet_length(whole) + 1).cast("long").alias("size"),
            F.crc32(whole).alias("text_crc32"),
            F.md5(whole).alias("group"),
        )
    )
    total = rows.count()
    quotas = _quotas(total, shards)
    groups = stored(rows.groupBy("group").agg(F.count("*").alias("group_rows")))
    linked = groups.filter("group_rows > 1")
    # A group's documents start dealt in turn from a shard of its own, over all shards or, if
    # half a shard would not hold them, over about as many as they need.
    quota = max(1, total // shards)
    dealt = linked.withColumn(
        "wide", F.expr(f"if(2 * group_rows > {quota}, least({shards}, group_rows div {quota} + 2), {shards})")
    ).selectExpr(
        "group",
        f"explode(transform(sequence(0, wide - 1), i -> struct(cast(pmod(xxhash64(group) + i, {shards}) as int) as shard,"
        " group_rows div wide + if(i < group_rows % wide, 1, 0) as n))) as x",
    )
    state = propagate(stored(dealt.selectExpr("group", "x.shard", "x.n").filter("n > 0")), shards, quotas, rounds)
    held = {row.shard: row.n for row in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    # A shard over its quota gives the surplus back; it holds the last of its groups by hash.
    state = _within(state, held, quotas, shards)
    held = {row.shard: row.n for row in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}

    # A group's places in turn belong to its shards.
    ends = Window.partitionBy("group").orderBy("shard")
    spans = (
        state.withColumn("end", F.sum("n").over(ends))
        .groupBy("group")
        .agg(F.array_sort(F.collect_list(F.struct("end", "shard"))).alias("spans"))
    )
    known = rows.join(groups, "group")
    in_groups = ranked(known.filter("group_rows > 1"), ["group"], ["doc_id"], "place", total).join(spans, "group")
    linked_rows = in_groups.withColumn("shard", F.expr("filter(spans, x -> x.end > place)[0].shard"))
    free = [quotas[shard] - held.get(shard, 0) for shard in range(shards)]
    alone = ranked(known.filter("group_rows = 1").withColumn("all", F.lit(0)), ["all"], ["doc_id", "group"], "place", total)
    single_rows = alone.withColumn("shard", F.expr(_by_place(free, "place", range(shards))))
    names = ["doc_id", "size", "text_crc32", "shard", "group", "group_rows"]
    placed = stored(linked_rows.select(*names).unionByName(single_rows.select(*names)))
    return ranked(placed, ["shard"], ["doc_id", "group"], "slot", total).selectExpr(
        "doc_id",
        "size",
        "text_crc32",
        "'rows' as law",
        "cast(shard as int) as shard",
        "cast(slot as bigint) as slot",
        "cast(null as int) as grown_shard",
        "group_rows",
    )


def _within(state: DataFrame, held: dict[int, int], quotas: list[int], shards: int) -> DataFrame:
    """``state`` with no shard over its quota."""
    over = {shard: n - quotas[shard] for shard, n in held.items() if n > quotas[shard]}
    if not over:
        return state
    spark = state.sparkSession
    excess = spark.createDataFrame([(s, n) for s, n in over.items()], "shard int, excess long")
    parts = max(1, state.count() // 20_000)
    split = state.withColumn("part", F.expr(f"pmod(xxhash64(group), {parts})"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        split.groupBy("shard", "part")
        .agg(F.sum("n").alias("total"))
        .withColumn("start", F.coalesce(F.sum("total").over(before), F.lit(0)))
        .drop("total")
    )
    inside = Window.partitionBy("shard", "part").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    giving = (
        split.withColumn("ahead", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(starts, ["shard", "part"])
        .join(F.broadcast(excess), "shard")
        .withColumn("first", F.col("start") + F.col("ahead"))
        .withColumn("go", F.expr("greatest(0, least(n, excess - first))"))
        .filter("go > 0")
    )
    # Surplus rows in a row fill the free places of the other shards in turn.
    base, run = [], 0
    for shard in sorted(over):
        base.append(f"when shard = {shard} then {run}")
        run += over[shard]
    free = [(s, quotas[s] - held.get(s, 0)) for s in range(shards) if quotas[s] > held.get(s, 0)]
    spans, start = [], 0
    for shard, n in free:
        spans.append(f"struct({shard} as to, {start}L as lo, {start + n}L as hi)")
        start += n
    placed = (
        giving.withColumn("lo", F.expr(f"first + case {' '.join(base)} end"))
        .selectExpr("group", "shard", "go", "lo", f"explode(array({', '.join(spans)})) as x")
        .withColumn("n", F.expr("least(lo + go, x.hi) - greatest(lo, x.lo)"))
        .filter("n > 0")
    )
    moved = placed.selectExpr("group", "explode(array(struct(shard, -n as n), struct(x.to as shard, n))) as y")
    return stored(
        state.unionByName(moved.selectExpr("group", "y.shard", "y.n"))
        .groupBy("group", "shard")
        .agg(F.sum("n").alias("n"))
        .filter("n > 0")
    )
