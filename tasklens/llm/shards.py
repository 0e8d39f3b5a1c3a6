"""Balanced label propagation over documents (dealt operator 2), with DataFrame functions only.

Documents with equal texts are linked through their text. A text with more copies than a shard holds is cut into pieces that
fill a shard each, and a rest; every other text is one piece. Every linked document starts in a shard of its own; in each
round the copies of a piece move towards the shard where most of them are, as far as the shards' quotas allow: what two shards
swap changes no size, so equally good goals are told apart by a hash, which lets as many go one way as the other. Copies of one
piece in one shard are alike, so they are kept as counts.

What is cut then is settled: each piece goes to its fullest shard as a whole, shards above their capacity give up whole pieces,
small ones first, and those fill the room of the others, large ones first. Only pieces that fit nowhere whole are
cut, at most about one for each shard. Documents without links fill what room is left, which makes the shards' sizes exact:
counts differ by one at most.

Ranks over a whole shard would gather it in one task. They are made in two steps instead: by row within a hash bucket, and
by bucket, with about as many buckets as rows in each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from tasklens.llm.storage import stored
from tasklens.session import checkpointed

ROUNDS = 6
# Times that what waits for room is lined up again.
SETTLING = 4
_PIECE = ["text_id", "piece"]
_CELL = [*_PIECE, "shard", "n"]


def _ranked(
    df: DataFrame, keys: list[str], order: list[str], out: str, buckets: int, weight: Column | None = None, first: Column | None = None
) -> DataFrame:
    """Add a rank from 0 within ``keys``, or the sum of ``weight`` over the rows before, in an order fixed by ``order``.

    ``first`` is a small whole number, at most 63, by which rows are ordered before that.
    """
    value = F.lit(1) if weight is None else weight
    bucket = F.pmod(F.xxhash64(*order), F.lit(buckets)) + (F.lit(0) if first is None else first * buckets)
    rows = df.withColumns({"_bucket": bucket.cast("long"), "_value": value.cast("long")})
    totals = rows.groupBy(*keys, "_bucket").agg(F.sum("_value").alias("_total"))
    before = Win.partitionBy(*keys).orderBy("_bucket").rowsBetween(Win.unboundedPreceding, -1)
    offsets = totals.withColumn("_offset", F.coalesce(F.sum("_total").over(before), F.lit(0))).drop("_total")
    within = Win.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Win.unboundedPreceding, -1)
    inner = rows.withColumn("_inner", F.coalesce(F.sum("_value").over(within), F.lit(0)))
    joined = inner.join(offsets, [*keys, "_bucket"])
    return joined.withColumn(out, F.col("_inner") + F.col("_offset")).drop("_bucket", "_value", "_inner", "_offset")


def _large_first(n: Column) -> Column:
    """0 for the largest counts, one more for each halving."""
    return F.lit(63) - F.floor(F.log2(F.greatest(n, F.lit(1)))).cast("int")


def _root(n: int) -> int:
    return max(1, math.isqrt(max(0, n)))


def _propagated(cells: DataFrame, shards: int, capacity: DataFrame, rounds: int) -> DataFrame:
    """``text_id, piece, shard, n`` after the rounds: how many copies of each piece stand in each shard."""
    for turn in range(rounds):
        # Among equally full shards the goal is any, so that flows between two shards are about equal.
        of_text = Win.partitionBy(*_PIECE).orderBy(F.desc("n"), F.xxhash64(*_PIECE, "shard", F.lit(turn)))
        wanted = cells.withColumn("goal", F.first("shard").over(of_text))
        asked = wanted.filter("shard <> goal")
        # Only flows between pairs of shards reach one place: at most shards squared rows.
        flows = asked.groupBy("shard", "goal").agg(F.sum("n").alias("flow"))
        back = flows.select(F.col("shard").alias("goal"), F.col("goal").alias("shard"), F.col("flow").alias("counter"))
        loads = cells.groupBy("shard").agg(F.sum("n").alias("load"))
        room = capacity.join(loads, "shard", "left").select(
            F.col("shard").alias("goal"), F.greatest(F.col("capacity") - F.coalesce("load", F.lit(0)), F.lit(0)).alias("room")
        )
        # What two shards swap changes no size; beyond that, a shard's room is dealt to those who ask, in order.
        asking = flows.join(back, ["shard", "goal"], "left").join(room, "goal")
        swap = F.least("flow", F.coalesce("counter", F.lit(0)))
        earlier = Win.partitionBy("goal").orderBy("shard").rowsBetween(Win.unboundedPreceding, -1)
        quota = asking.withColumn("swap", swap).withColumn("more", F.col("flow") - F.col("swap"))
        quota = quota.withColumn("taken", F.coalesce(F.sum("more").over(earlier), F.lit(0)))
        granted = F.col("swap") + F.least("more", F.greatest(F.col("room") - F.col("taken"), F.lit(0)))
        quota = checkpointed(quota.select("shard", "goal", granted.alias("quota"), "flow"))
        totals = quota.agg(F.sum("quota"), F.sum("flow"), F.count("*")).first()
        if not totals[0]:
            break
        ranked = _ranked(asked, ["shard", "goal"], _PIECE, "before", _root(totals[1]), F.col("n"))
        moving = ranked.join(quota, ["shard", "goal"]).withColumn(
            "moved", F.least("n", F.greatest(F.col("quota") - F.col("before"), F.lit(0)))
        )
        arrivals = moving.select(*_PIECE, F.col("goal").alias("shard"), F.col("moved").alias("n"))
        leavers = moving.select(*_PIECE, "shard", (-F.col("moved")).alias("n"))
        after = cells.select(*_PIECE, "shard", "n").unionByName(arrivals).unionByName(leavers)
        cells = checkpointed(after.groupBy(*_PIECE, "shard").agg(F.sum("n").alias("n")).filter("n > 0"))
    return cells


def _rooms(placed: DataFrame, capacity: DataFrame) -> list[tuple[int, int]]:
    """(shard, room) of every shard: as many rows as there are shards."""
    loads = placed.groupBy("shard").agg(F.sum("n").alias("load"))
    left = capacity.join(loads, "shard", "left").select("shard", (F.col("capacity") - F.coalesce("load", F.lit(0))).alias("room"))
    return [(r.shard, r.room) for r in left.collect()]


def _by_room(at: Column, rooms: list[tuple[int, int]], ends: bool = False) -> Column:
    """The shard in whose room a place of the line of all rooms lies, or where that room ends."""
    out, reach = F.lit(None).cast("long"), sum(room for _, room in rooms)
    for shard, room in reversed(rooms):
        out = F.when(at < reach, F.lit(reach if ends else shard).cast("long")).otherwise(out)
        reach -= room
    return out


def _giants(whole: DataFrame, capacity: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pieces that take more than half a shard, each in one, and what capacity they leave.

    There are fewer of them than twice the shards, so they are placed one by one; the others go round them.
    """
    room = {r.shard: r.capacity for r in capacity.collect()}
    half = max(room.values(), default=0) / 2
    large = whole.filter(F.col("n") > half).orderBy(F.desc("n"), *_PIECE).limit(2 * len(room)).collect()
    rows = []
    for r in large:
        own = r.shard if room[r.shard] >= r.n else max(room, key=lambda s: room[s])
        if room[own] >= r.n:
            room[own] -= r.n
            rows.append((r.text_id, r.piece, own, r.n))
    spark = whole.sparkSession
    types = {f.name: f.dataType.simpleString() for f in whole.schema}
    giants = spark.createDataFrame(rows, ", ".join(f"{c} {types[c]}" for c in _CELL))
    return giants, spark.createDataFrame(sorted(room.items()), "shard int, capacity long")


def _settled(cells: DataFrame, capacity: DataFrame) -> DataFrame:
    """``text_id, piece, shard, n``: every piece in one shard, but for those that no shard has room for as a whole."""
    whole = cells.groupBy(*_PIECE).agg(F.max(F.struct("n", "shard")).alias("most"), F.sum("n").alias("n"))
    whole = checkpointed(whole.select(*_PIECE, F.col("most.shard").alias("shard"), "n"))
    count = whole.count()
    giants, capacity_left = _giants(whole, capacity)
    whole = whole.join(F.broadcast(giants.select(*_PIECE)), _PIECE, "left_anti")
    capacity = capacity_left
    ranked = _ranked(whole, ["shard"], _PIECE, "before", _root(count), F.col("n"), _large_first(F.col("n")))
    ranked = checkpointed(ranked.join(capacity, "shard"))
    fits = F.col("before") + F.col("n") <= F.col("capacity")
    placed, waiting = ranked.filter(fits).select(*_CELL), ranked.filter(~fits).select(*_PIECE, "n")
    for _ in range(SETTLING):
        rooms = sorted(_rooms(placed, capacity), key=lambda r: -r[1])
        # The line of all rooms, the widest first, meets the line of all that waits, the largest first.
        lined = _ranked(waiting.withColumn("_all", F.lit(0)), ["_all"], _PIECE, "before", _root(count), F.col("n"), _large_first(F.col("n")))
        at = F.col("before")
        lined = lined.withColumns({"shard": _by_room(at, rooms).cast("int"), "_end": _by_room(at, rooms, ends=True)})
        lined = checkpointed(lined.withColumn("_fits", F.coalesce(at + F.col("n") <= F.col("_end"), F.lit(False))))
        placed = checkpointed(placed.unionByName(lined.filter("_fits").select(*_CELL)))
        waiting = checkpointed(lined.filter("not _fits").select(*_PIECE, "n"))
        if waiting.isEmpty():
            return placed.unionByName(giants)
    # What fits nowhere as a whole is dealt out to what is left, by copies.
    rooms = sorted(_rooms(placed, capacity), key=lambda r: -r[1])
    lined = _ranked(waiting.withColumn("_all", F.lit(0)), ["_all"], _PIECE, "before", _root(count), F.col("n"))
    cut, start = None, 0
    for shard, room in rooms:
        share = F.least(F.col("before") + F.col("n"), F.lit(start + room)) - F.greatest(F.col("before"), F.lit(start))
        part = lined.select(*_PIECE, F.lit(shard).alias("shard"), share.cast("long").alias("n")).filter("n > 0")
        cut = part if cut is None else cut.unionByName(part)
        start += room
    return checkpointed(placed.unionByName(cut).unionByName(giants))


def balanced_shards(
    docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS
) -> DataFrame:
    """Per row: ``doc_id``, ``size`` (UTF-8 bytes of the text and 1), ``text_crc32``, ``shard`` and ``slot``.

    Shards hold equally many rows, or one more for the first few; slots count from 0 within a shard. Rows with equal
    texts go to one shard; a text that outgrows a shard fills as few as hold it, and where copies leave hardly a row free, about one
    text a shard may be cut. Null texts count
    as no bytes and are linked with nothing; empty texts are equal texts. Rows without an id, and rows that repeat
    one, are rows like others. An empty table gives an empty table.
    """
    text = F.col(text_col)
    body = F.coalesce(text, F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.when(text.isNotNull(), F.sha2(body, 256)).alias("text_id"),
    )
    # Rows that are alike in everything are told apart by a number of their own, fixed once it is written.
    rows = stored(rows.withColumn("row_id", F.monotonically_increasing_id()), "rows")
    spark = docs.sparkSession
    total = rows.count()
    least, more = divmod(total, shards)
    capacity = spark.createDataFrame([(s, least + (s < more)) for s in range(shards)], "shard int, capacity long")
    copies = rows.filter("text_id is not null").groupBy("text_id").agg(F.count("*").alias("copies")).filter("copies > 1")
    copies = checkpointed(copies)
    # The copies of a text, counted through, are cut into pieces that fit into a shard.
    counted = _ranked(rows.join(copies.select("text_id"), "text_id").select("text_id", "row_id"), ["text_id"], ["row_id"], "nth", _root(total))
    most = max(1, least)
    counted = stored(counted.withColumn("piece", F.floor(F.col("nth") / most)).withColumn("nth", F.col("nth") % most), "copies")
    start = F.pmod(F.xxhash64("row_id"), F.lit(shards)).cast("int")
    cells = checkpointed(counted.groupBy(*_PIECE, start.alias("shard")).agg(F.count("*").alias("n")))
    kept = _settled(_propagated(cells, shards, capacity, rounds), capacity)
    # A piece has one stretch of its copies per shard, nearly always one.
    upto = Win.partitionBy(*_PIECE).orderBy("shard")
    stretches = kept.withColumn("upto", F.sum("n").over(upto)).groupBy(*_PIECE).agg(
        F.array_sort(F.collect_list(F.struct("upto", "shard"))).alias("stretches")
    )
    loads = kept.groupBy("shard").agg(F.sum("n").alias("load"))
    own = F.filter("stretches", lambda s: s["upto"] > F.col("nth"))
    assigned = counted.join(stretches, _PIECE, "left").select("row_id", F.get(own, F.lit(0))["shard"].alias("shard"))
    assigned = stored(rows.drop("text_id").join(assigned, "row_id", "left"), "assigned")

    # Rows that no link holds fill the room, in stretches of their count.
    room = capacity.join(loads, "shard", "left").withColumn("room", F.col("capacity") - F.coalesce("load", F.lit(0)))
    ends = F.sum("room").over(Win.partitionBy(F.lit(0)).orderBy("shard"))
    edges = room.select("shard", ends.alias("ends")).agg(F.array_sort(F.collect_list(F.struct("ends", "shard"))).alias("edges"))
    edges = checkpointed(edges).first()["edges"]
    free = _ranked(assigned.filter("shard is null").withColumn("_all", F.lit(0)), ["_all"], ["row_id"], "nth", _root(total))
    chosen = F.lit(None).cast("int")
    for edge in reversed(edges or []):
        chosen = F.when(F.col("nth") < edge["ends"], edge["shard"]).otherwise(chosen)
    filled = free.withColumn("shard", chosen).drop("_all", "nth")
    whole = assigned.filter("shard is not null").unionByName(filled)
    slotted = _ranked(whole, ["shard"], ["row_id"], "slot", _root(total // max(1, shards)))
    return slotted.select("doc_id", "size", "text_crc32", "shard", "slot")
