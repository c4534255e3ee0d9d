"""Sharding on a consistent-hash ring with virtual nodes and bounded loads, in Spark expressions only.

Law `rows`: shards may hold floor(n / shards) documents, the first n mod shards one more.  Each shard
owns `NODES` points of the ring and takes the documents that lie in the arcs before its points, up to
its bound; those of an arc that find it full continue clockwise to the next shard with room.  So counts
differ by one at most, and a document moves only when its shard, or those it passed, fill differently.

The documents of an arc are dealt into `CELLS` cells.  Counts per cell (a table whose size depends on the number
of shards only) give each document its rank in its arc; the walk is a fold over the arcs' counts.

Cases: null text counts as empty (size 8, checksum 0); null doc_ids lie at one place of the ring;
repeated rows are placed one by one; fewer documents than shards leave shards empty; an empty table
gives no rows; other columns are not read.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

NODES = 64
CELLS = 16
SPACE = 2**32


def _point(*parts):
    """A place on the ring: the first 32 bits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws("-", *parts)), 1, 8), 16, 10).cast("long")


def ring(spark, shards, nodes=NODES):
    """The arcs in order: arc, lo (exclusive), hi, shard."""
    points = (spark.range(shards * nodes)
              .select((F.col("id") % shards).alias("shard"), F.floor(F.col("id") / shards).alias("node"))
              .select("shard", _point(F.lit("shard"), "shard", "node").alias("hi")))
    points = points.groupBy("hi").agg(F.min("shard").alias("shard"))
    order = Window.orderBy("hi")
    return points.select((F.row_number().over(order) - 1).alias("arc"),
                         F.lag("hi", 1, -1).over(order).alias("lo"), "hi", "shard")


def _walk(arcs, shards):
    """Fold over the arcs: what each arc (in ring order) puts where.

    In: rows arc, shard, n, own (documents its own shard takes), room (of the shard after that).  Out: one row per
    arc and shard with first, past (ranks in the arc) in the order of the walk.
    """
    one = arcs.agg(F.sort_array(F.collect_list(F.struct("arc", "shard", "n", "own"))).alias("a"),
                   F.sort_array(F.collect_set(F.struct("shard", "room"))).alias("r"))
    # a shard without a point of its own takes what is left last, like any other
    room = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.coalesce(
        F.get(F.filter("r", lambda x: x["shard"] == s), F.lit(0))["room"], F.lit(0)))
    start = F.struct(room.cast("array<bigint>").alias("room"), F.expr("cast(array() as array<struct<arc:int,shard:bigint,first:bigint,past:bigint>>)").alias("out"))
    # an arc that overflows goes to the shards in the order in which the ring, once round, comes to them
    step = """aggregate(a, start, (acc, x) -> IF(x.n = x.own, acc,
        aggregate(array_distinct(concat(slice(s, x.arc + 1, size(s)), slice(s, 1, x.arc), sequence(0L, %dL))), named_struct('room', acc.room, 'out', acc.out, 'at', x.own),
            (b, s) -> IF(b.at >= x.n OR b.room[s] = 0, b, named_struct(
                'room', transform(b.room, (r, k) -> IF(k = s, r - least(r, x.n - b.at), r)),
                'out', concat(b.out, array(named_struct('arc', x.arc, 'shard', s, 'first', b.at,
                                                        'past', b.at + least(b.room[s], x.n - b.at)))),
                'at', b.at + least(b.room[s], x.n - b.at))),
            b -> named_struct('room', b.room, 'out', b.out))), acc -> acc.out)""" % (shards - 1)
    ordered = one.withColumn("s", F.transform("a", lambda x: x["shard"]))
    moved = ordered.select("a", "s", start.alias("start")).select(F.expr(step).alias("m")).select(
        F.explode("m").alias("m")).select("m.*")
    own = arcs.filter("own > 0").select("arc", "shard", F.lit(0).cast("long").alias("first"), F.col("own").alias("past"))
    return own.union(moved)


def shard(docs, shards, doc_id="doc_id", text="text", nodes=NODES, cells=CELLS):
    """doc_id, size, text_crc32, shard and slot (gapless within the shard) of every document."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), (F.octet_length(body) + 8).cast("long").alias("size"),
                    F.crc32(body.cast("binary")).alias("text_crc32"))
    d = d.withColumn("p", _point(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    arcs = ring(spark, shards, nodes)
    # the ends of the arcs are one bounded array, searched by halves
    ends = arcs.agg(F.sort_array(F.collect_list(F.struct("hi", "arc"))).alias("hs")).scalar()
    find = """coalesce(aggregate(sequence(1, {steps}), named_struct('l', 0L, 'h', bigint(size(hs))),
        (s, i) -> IF(s.l >= s.h, s, IF(hs[int((s.l + s.h) div 2)].hi < p,
            named_struct('l', (s.l + s.h) div 2 + 1, 'h', s.h), named_struct('l', s.l, 'h', (s.l + s.h) div 2))),
        s -> IF(s.l >= size(hs), 0L, s.l)), 0L)""".format(steps=(shards * nodes).bit_length() + 1)
    d = d.withColumn("hs", ends).withColumn("arc", F.expr(find).cast("int")).drop("hs")
    d = d.withColumn("cell", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(cells)).cast("int"))
    cell = d.groupBy("arc", "cell").agg(F.count("*").alias("c"))
    before = Window.partitionBy("arc").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cell = cell.withColumn("skip", F.coalesce(F.sum("c").over(before), F.lit(0)))

    n = cell.groupBy("arc").agg(F.sum("c").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    by_arc = (arcs.select("arc", F.col("shard").cast("long").alias("shard")).join(n, "arc", "left").fillna(0, ["n"])
              .withColumn("bound", F.floor(total / shards) + F.when(F.col("shard") < total % shards, 1).otherwise(0)))
    ahead = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("arc").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    by_arc = by_arc.withColumn("own", F.least("n", F.greatest(F.col("bound") - ahead, F.lit(0))))
    by_arc = by_arc.withColumn("room", F.col("bound") - F.sum("own").over(Window.partitionBy("shard")))
    pieces = _walk(by_arc, shards)
    filled = F.coalesce(F.sum(F.col("past") - F.col("first")).over(
        Window.partitionBy("shard").orderBy("arc", "first").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = pieces.withColumn("base", filled)

    inner = Window.partitionBy("arc", "cell").orderBy("p", "doc_id", "text_crc32", "size")
    ranked = d.withColumn("rank", F.row_number().over(inner) - 1).join(
        F.broadcast(cell.select("arc", "cell", "skip")), ["arc", "cell"]).withColumn("rank", F.col("rank") + F.col("skip"))
    placed = ranked.join(F.broadcast(pieces.withColumnRenamed("arc", "on")), (F.col("arc") == F.col("on"))
                         & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("past")))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
                         (F.col("base") + F.col("rank") - F.col("first")).cast("long").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))
