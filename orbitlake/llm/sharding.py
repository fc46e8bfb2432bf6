"""Minimum-cost-flow resharding: from old shard sizes to new capacities with the fewest bytes moved.

Every old shard is cut into blocks by a hash of the id; only block sums are gathered. Rows larger
than a small share of a new shard (their number is bounded by that share) are placed one by one; all others flow: a
transport problem from old shards to new ones, where staying costs nothing and moving costs one a byte. The flow
becomes byte ranges of each old shard, so that a row's new shard and slot follow from its block's start and its place
in the block.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import materialize, read, text_or_empty

#: Blocks of an old shard: as many as bring a block of the largest one to ROWS_A_BLOCK rows or so, within these two. Their sums go to the driver.
BLOCKS, ROWS_A_BLOCK = (256, 16_384), 200_000
#: Rows of a file when shards are rewritten.
ROWS_A_FILE = 1_000_000
#: A row above 1 / (LARGE_SHARE * new shards) of all bytes is placed by itself; there are at most LARGE_SHARE * new shards of them.
LARGE_SHARE = 64
ROW_BYTES = 16


def min_cost_flow(supply: list[int], demand: list[int], cost) -> dict[tuple[int, int], int]:
    """Units sent from each source to each sink at the least total cost, by successive shortest paths with potentials. supply and
    demand have equal sums; cost(i, j) is the price of a unit from i to j."""
    n, m = len(supply), len(demand)
    s, t, size = n + m, n + m + 1, n + m + 2
    graph: list[list[int]] = [[] for _ in range(size)]
    to, cap, price = [], [], []

    def edge(a: int, b: int, c: int, w: int) -> None:
        for x, y, c0, w0 in ((a, b, c, w), (b, a, 0, -w)):
            graph[x].append(len(to))
            to.append(y), cap.append(c0), price.append(w0)

    for i, x in enumerate(supply):
        if x:
            edge(s, i, x, 0)
    for j, x in enumerate(demand):
        if x:
            edge(n + j, t, x, 0)
    first = len(to)
    pairs = [(i, j) for i in range(n) if supply[i] for j in range(m) if demand[j]]
    for i, j in pairs:
        edge(i, n + j, min(supply[i], demand[j]), cost(i, j))
    potential = [0] * size
    while True:
        dist, back = [None] * size, [-1] * size
        dist[s], heap = 0, [(0, s)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > dist[a]:
                continue
            for e in graph[a]:
                b = to[e]
                if cap[e] and (dist[b] is None or d + price[e] + potential[a] - potential[b] < dist[b]):
                    dist[b], back[b] = d + price[e] + potential[a] - potential[b], e
                    heapq.heappush(heap, (dist[b], b))
        if dist[t] is None:
            break
        far = max(d for d in dist if d is not None)
        potential = [p + (far if d is None else d) for p, d in zip(potential, dist)]
        path, b = [], t
        while b != s:
            path.append(back[b])
            b = to[back[b] ^ 1]
        units = min(cap[e] for e in path)
        for e in path:
            cap[e] -= units
            cap[e ^ 1] += units
    return {p: cap[first + 2 * k + 1] for k, p in enumerate(pairs) if cap[first + 2 * k + 1]}


def _place_large(rows: list[tuple[int, int]], capacity: list[float]) -> list[int]:
    """Rows (old shard, size), largest first: a row stays where it is if it fits, else goes to the emptiest new shard."""
    room, out = list(capacity), []
    for old, size in rows:
        to = old if old < len(room) and room[old] >= size else max(range(len(room)), key=lambda j: (room[j], -j))
        room[to] -= size
        out.append(to)
    return out


def _levels(total: int, used: list[int], weight: list[float]) -> list[int]:
    """What each new shard still takes of total: used + taken level out at a common multiple of weight, or taken is 0."""
    open_ = sorted(range(len(used)), key=lambda j: used[j] / weight[j])
    for k in range(len(open_), 0, -1):
        level = (total + sum(used[j] for j in open_[:k])) / sum(weight[j] for j in open_[:k])
        if used[open_[k - 1]] <= level * weight[open_[k - 1]]:
            break
    take = [0] * len(used)
    for j in open_[:k]:
        take[j] = max(0, int(level * weight[j]) - used[j])
    short = total - sum(take)
    for i in range(abs(short)):
        take[open_[i % k]] += 1 if short > 0 else -1
    return take


def reshard(docs: DataFrame, old_shard, n_old: int, weights: list[float], text: str = "text", tag: str = "reshard") -> DataFrame:
    """docs: doc_id, text and what old_shard, a column of integers from 0 to n_old - 1, needs. weights: the new shards' capacities, in proportion.
    One row per input row: doc_id, size (UTF-8 bytes of the text plus 16), text_crc32, old_shard, shard, slot, moved (is in another shard than before).

    Nulls: a null text has no bytes and the CRC 0; a null old shard counts as 0; a null id is a key like any other. Repeated rows are rows of
    their own with slots of their own. Equal rows may trade slots. An empty table gives no rows. A row larger than a shard's capacity overfills it alone."""
    n_new = len(weights)
    base = docs.select("doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"), F.crc32(text_or_empty(text).cast("binary")).alias("text_crc32"), F.coalesce(old_shard, F.lit(0)).cast("int").alias("old_shard"), F.xxhash64("doc_id").alias("_h"))
    base = materialize(base, tag)
    most = max((r["n"] for r in base.groupBy("old_shard").agg(F.count(F.lit(1)).alias("n")).collect()), default=0)  # n_old rows
    n_blocks = min(max(BLOCKS[0], -(-most // ROWS_A_BLOCK)), BLOCKS[1])
    base = base.withColumn("_block", F.pmod("_h", F.lit(n_blocks)).cast("int"))
    total = base.agg(F.sum("size")).first()[0] or 0
    limit = total // (LARGE_SHARE * n_new)
    capacity = [total * w / sum(weights) for w in weights]

    by_block = [F.asc_nulls_first(c) for c in ("_h", "doc_id", "text_crc32", "size")]
    # at most LARGE_SHARE * n_new groups: each row in them has more than `limit` bytes
    large = base.where(F.col("size") > limit).groupBy("old_shard", "_block", "_h", "doc_id", "text_crc32", "size").count()
    found = sorted(((r["size"], r["old_shard"], r["_block"], r["_h"], r["doc_id"], r["text_crc32"], r["count"]) for r in large.collect()), key=lambda r: (-r[0], r[1], r[3], str(r[4]), r[5])) if total else []
    each = [(r, k) for r in found for k in range(r[6])]
    went = _place_large([(r[1], r[0]) for r, _ in each], capacity)
    used = [0] * n_new
    for (r, _), j in zip(each, went):
        used[j] += r[0]

    small = base.where(F.col("size") <= limit)
    sums = small.groupBy("old_shard", "_block").agg(F.sum("size").alias("s"))
    blocks = sorted((r["old_shard"], r["_block"], r["s"]) for r in sums.collect())  # n_old * n_blocks rows at most
    supply = [0] * n_old
    starts = []
    for old, block, s in blocks:
        starts.append((old, block, supply[old]))
        supply[old] += s
    flow = min_cost_flow(supply, _levels(sum(supply), used, weights), lambda i, j: int(i != j))
    ranges = []  # (old, from, to, new): what stays comes first
    for old in range(n_old):
        at = 0
        for new, units in sorted(((j, u) for (i, j), u in flow.items() if i == old), key=lambda x: (x[0] != old, x[0])):
            ranges.append((old, at, at + units, new))
            at += units

    spark = docs.sparkSession
    cuts = spark.createDataFrame([(old, [x for o, _, x, _ in ranges if o == old][:-1], [j for o, _, _, j in ranges if o == old]) for old in sorted({r[0] for r in ranges})], "old_shard int, _cuts array<bigint>, _new array<int>")
    begin = spark.createDataFrame(starts, "old_shard int, _block int, _start bigint")
    w = W.partitionBy("old_shard", "_block").orderBy(*by_block)
    placed = small.join(F.broadcast(begin), ["old_shard", "_block"]).join(F.broadcast(cuts), "old_shard")
    placed = placed.withColumn("_at", F.col("_start") + F.sum("size").over(w.rowsBetween(W.unboundedPreceding, 0)) - F.col("size")).withColumn("_n", F.row_number().over(w))
    placed = placed.withColumn("shard", F.expr("element_at(_new, size(filter(_cuts, c -> c <= _at)) + 1)")).select("doc_id", "size", "text_crc32", "old_shard", "_block", "_n", "shard")
    kind = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *(T.StructField(c, T.LongType()) for c in ("size", "text_crc32")), *(T.StructField(c, T.IntegerType()) for c in ("old_shard", "_block", "_n", "shard"))])
    alone = spark.createDataFrame([(r[4], r[0], r[5], r[1], -1, k + 1, j) for k, ((r, _), j) in enumerate(zip(each, went))], kind)
    placed = materialize(placed.unionByName(alone), tag)

    parts = placed.groupBy("shard", "old_shard", "_block").agg(F.count(F.lit(1)).alias("n"), F.min("_n").alias("_first"), F.max("_n").alias("_last"))
    # large rows of a shard are numbered one by one, all others by their place in their block's part
    many = parts.where("_block >= 0").withColumn("_slot", F.sum("n").over(W.partitionBy("shard").orderBy("old_shard", "_block").rowsBetween(W.unboundedPreceding, 0)) - F.col("n")).drop("n", "_last")
    ahead = parts.where("_block >= 0").groupBy("shard").agg(F.sum("n").alias("_ahead"))
    few = placed.where("_block < 0").withColumn("_rank", F.row_number().over(W.partitionBy("shard").orderBy("_n"))).join(F.broadcast(ahead), "shard", "left")
    few = few.withColumn("slot", F.coalesce("_ahead", F.lit(0)) + F.col("_rank") - 1)
    rest = placed.where("_block >= 0").join(F.broadcast(many), ["shard", "old_shard", "_block"]).withColumn("slot", F.col("_slot") + F.col("_n") - F.col("_first"))
    cols = ["doc_id", "size", "text_crc32", "old_shard", "shard", F.col("slot").cast("long").alias("slot"), (F.col("shard") != F.col("old_shard")).alias("moved")]
    return rest.select(*cols).unionByName(few.select(*cols))


def rewrite(docs: DataFrame, plan: DataFrame, old_path: str, new_path: str, text: str = "text") -> DataFrame:
    """Rewrites the files that a plan of reshard affects. The old layout has a folder old_path/shard=N for each shard with rows. The rows of every shard that one joins or
    leaves are written, in order of their slots, under new_path/data/shard=N; files of all other shards are not touched, and nothing is written to old_path. The
    manifest, returned and written to new_path/manifest, lists shard, rows, path (null: the shard is empty now) and rewritten; read_layout reads by it.

    Rows meet the plan by id, size and CRC of the text, nulls included; rows that agree in all three take the plan's places in turn, so that each row is written once."""
    spark = docs.sparkSession
    after = plan.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"))
    touched = plan.where("moved").select(F.explode(F.array("shard", "old_shard")).alias("shard")).distinct()
    names = plan.select("shard").union(plan.select("old_shard")).distinct()
    manifest = names.join(after, "shard", "left").join(touched.withColumn("_t", F.lit(True)), "shard", "left").select("shard", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), F.coalesce("_t", F.lit(False)).alias("rewritten"))
    folder = F.concat(F.when(F.col("rewritten"), f"{new_path}/data/shard=").otherwise(f"{old_path}/shard="), F.col("shard").cast("string"))
    manifest = manifest.select("shard", "rows", F.when(F.col("rows") > 0, folder).alias("path"), "rewritten")
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{new_path}/manifest")  # one row a shard
    manifest = spark.read.parquet(f"{new_path}/manifest")

    alike = W.partitionBy("_i", "_s", "_c").orderBy(F.lit(0))
    to = plan.select(F.col("doc_id").alias("_i"), F.col("size").alias("_s"), F.col("text_crc32").alias("_c"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot")).withColumn("_k", F.row_number().over(alike))
    to = to.join(F.broadcast(manifest.where("rewritten").select(F.col("shard").alias("_shard"))), "_shard", "left_semi").withColumnRenamed("_k", "_place")
    rows = docs.withColumn("_i", F.col("doc_id")).withColumn("_s", (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")).withColumn("_c", F.crc32(text_or_empty(text).cast("binary")))
    rows = rows.withColumn("_k", F.row_number().over(alike)).select(*docs.columns, F.col("_s").alias("_size"), F.col("_c").alias("_crc"), "_k")
    same = F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("_size") == F.col("_s")) & (F.col("_crc") == F.col("_c")) & (F.col("_k") == F.col("_place"))
    full = rows.join(to, same).withColumn("_file", F.floor(F.col("_slot") / ROWS_A_FILE))
    full = full.repartition("_shard", "_file").sortWithinPartitions("_shard", "_slot").select(*docs.columns, F.col("_shard").alias("shard"))
    full.write.mode("overwrite").partitionBy("shard").parquet(f"{new_path}/data")
    return manifest


def read_layout(manifest: DataFrame) -> DataFrame:
    """The rows of all shards that a manifest lists."""
    paths = [r["path"] for r in manifest.where("path is not null").select("path").collect()]  # one a shard
    return manifest.sparkSession.read.parquet(*paths)


def old_by_source(n: int):
    """The layout to leave: shards by source, as uneven as the sources are."""
    return F.pmod(F.crc32(F.coalesce(F.col("source"), F.lit("")).cast("binary")), F.lit(n)).cast("int")


def op2_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From 32 shards by source to 40 of equal bytes."""
    out = reshard(read(spark, sf_dir, "documents"), old_by_source(32), 32, [1.0] * 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard", "moved")
