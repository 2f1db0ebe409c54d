"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix. DataFrame functions only.

1. Rows fall into input blocks by a hash of their identity (not by their physical partition, so a lost executor changes nothing). Rows with equal
   identities are counted, which combines map-side, and numbered by the count, so equal rows are shuffled apart like any others.
2. The matrix of block-to-shard counts is drawn exactly as a uniform permutation would give it: the block list is halved again
   and again, each half's share of every shard's seats being a multivariate hypergeometric draw (inverse transform from the mode).
3. Local permutation: rows of a block are put in a seeded random order and dealt out to shards by the block's row of counts.
4. Exchange, and a second permutation inside each shard that gives the slots. It is a distributed rank: rows are cut into
   ranges of a second seeded hash, range sizes are summed up, and only a range is ever sorted in one task.

Only ids, sizes and hashes are exchanged, never texts.

Defined results: null text counts 1 byte and has the checksum of no bytes; a null id is an id like others; repeated rows are separate rows, each
with its own place; rows with equal ids, sizes and checksums stand in no order among themselves; texts of any length only give their size and checksum; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.llm.common import let, materialise, unit_interval

ROWS_PER_BLOCK = 50_000
SEED = 20_240_601


def log_factorial(x: Column) -> Column:
    """ln(x!) by Stirling's series after a shift by 8, with an error below 1e-12."""

    def of(z: Column) -> Column:
        y = z + 8.0
        return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + 1.0 / (12.0 * y) - 1.0 / (360.0 * F.pow(y, F.lit(3.0))) + 1.0 / (1260.0 * F.pow(y, F.lit(5.0)))

    def shift(z: Column) -> Column:
        out = z
        for k in range(1, 8):
            out = out * (z + float(k))
        return F.log(out)

    return let(x.cast("double") + 1.0, lambda z: of(z) - shift(z))


def hypergeometric(total: Column, good: Column, draws: Column, u: Column) -> Column:
    """Number of good items among ``draws`` out of ``total``: inverse transform of u, walking outwards from the mode.

    Every intermediate value is bound once, so the expression stays small.
    """
    zero = F.lit(0).cast("long")
    d = lambda c: c.cast("double")

    def start(a: Column) -> Column:
        lo, hi = F.greatest(zero, a["draws"] + a["good"] - a["total"]), F.least(a["good"], a["draws"])
        peak = F.floor(d(a["draws"] + 1) * d(a["good"] + 1) / d(a["total"] + 2))
        share = d(a["good"]) / d(F.greatest(a["total"], F.lit(1)))
        reach = F.ceil(F.sqrt(d(a["draws"]) * share * (1.0 - share)) * 12.0 + 40.0).cast("long")
        return F.struct(*[a[k].alias(k) for k in ("total", "good", "draws", "u")], (a["total"] - a["good"]).alias("bad"), lo.alias("lo"), hi.alias("hi"), F.least(hi, F.greatest(lo, peak)).alias("mode"), F.least(hi - lo, reach).alias("reach"))

    def walk(a: Column) -> Column:
        m = a["mode"]
        ways = lambda n, k: log_factorial(n) - log_factorial(k) - log_factorial(n - k)
        log_p = ways(a["good"], m) + ways(a["bad"], a["draws"] - m) - ways(a["total"], a["draws"])

        def step(acc: Column, _: Column) -> Column:
            x, y = acc["up"], acc["down"]
            # weights of the next value above and below
            up = F.when(x < a["hi"], acc["pu"] * d(a["good"] - x) * d(a["draws"] - x) / (d(x + 1) * d(a["bad"] - a["draws"] + x + 1))).otherwise(F.lit(0.0))
            down = F.when(y > a["lo"], acc["pd"] * d(y) * d(a["bad"] - a["draws"] + y) / (d(a["good"] - y + 1) * d(a["draws"] - y + 1))).otherwise(F.lit(0.0))

            def moved(w: Column) -> Column:
                left, above, below = acc["left"], F.least(a["hi"], x + 1), F.greatest(a["lo"], y - 1)
                is_up, is_down = (left > 0) & (left <= w["up"]), (left > w["up"]) & (left <= w["up"] + w["down"])
                return F.struct(
                    F.when(left <= 0, left).when(is_up | is_down, F.lit(-1.0)).otherwise(left - w["up"] - w["down"]).alias("left"),
                    above.alias("up"), below.alias("down"), w["up"].alias("pu"), w["down"].alias("pd"),
                    F.when(is_up, above).when(is_down, below).otherwise(acc["got"]).alias("got"),
                )

            return let(F.struct(up.alias("up"), down.alias("down")), moved)

        def run(p: Column) -> Column:
            first = F.struct((a["u"] - p).alias("left"), m.alias("up"), m.alias("down"), p.alias("pu"), p.alias("pd"), m.alias("got"))
            return F.aggregate(F.sequence(F.lit(1).cast("long"), a["reach"]), first, step, lambda acc: acc["got"])

        return F.when(a["hi"] <= a["lo"], a["lo"]).otherwise(let(F.exp(log_p), run))

    given = F.struct(total.alias("total"), good.alias("good"), draws.alias("draws"), u.alias("u"))
    return let(let(given, start), walk)


def communication_matrix(sizes: DataFrame, n_blocks: int, n_shards: int, seed: int = SEED) -> DataFrame:
    """(node, share array<long>): how many rows of block ``node - n_blocks`` go to each shard.

    ``sizes`` has (block, n) for blocks 0 .. n_blocks-1, a power of two; missing blocks are empty. Shard capacities are as equal as can be.
    The table has n_blocks rows; rows of documents never meet here.
    """
    spark = sizes.sparkSession
    every = spark.range(n_blocks).select(F.col("id").alias("block")).join(sizes, "block", "left").select("block", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    root = every.agg(F.transform(F.sort_array(F.collect_list(F.struct("block", "n"))), lambda x: x["n"]).alias("sizes"))
    total = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    caps = F.transform(F.sequence(F.lit(0), F.lit(n_shards - 1)), lambda s: (F.floor(total / n_shards) + F.when(s < F.pmod(total, F.lit(n_shards)), 1).otherwise(0)).cast("long"))
    node = root.select(F.lit(1).cast("long").alias("node"), "sizes", caps.alias("caps"))
    while n_blocks > 1:
        n_blocks //= 2
        node = node.select("node", "caps", F.slice("sizes", 1, n_blocks).alias("a"), F.slice("sizes", n_blocks + 1, n_blocks).alias("b"))
        draws = F.aggregate("a", F.lit(0).cast("long"), lambda x, y: x + y)
        total = F.aggregate("caps", F.lit(0).cast("long"), lambda x, y: x + y)

        def one(acc: Column, s: Column) -> Column:
            got = hypergeometric(acc["total"], F.get("caps", s), acc["draws"], unit_interval(seed, F.col("node"), s))
            return let(got, lambda g: F.struct((acc["total"] - F.get("caps", s)).alias("total"), (acc["draws"] - g).alias("draws"), F.concat(acc["out"], F.array(g)).alias("out")))

        left = F.aggregate(F.sequence(F.lit(0), F.lit(n_shards - 1)), F.struct(total.alias("total"), draws.alias("draws"), F.array().cast("array<bigint>").alias("out")), one, lambda acc: acc["out"])
        node = node.withColumn("left", left)
        halves = F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("a").alias("sizes"), F.col("left").alias("caps")),
            F.struct((F.col("node") * 2 + 1).alias("node"), F.col("b").alias("sizes"), F.zip_with("caps", "left", lambda x, y: x - y).alias("caps")),
        )
        node = node.select(F.explode(halves).alias("h")).select("h.*")
    return node.select("node", F.col("caps").alias("share"))


def shuffled(docs: DataFrame, n_shards: int = 16, seed: int = SEED, rows_per_block: int = ROWS_PER_BLOCK, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): a uniform random permutation cut into ``n_shards`` shards of equal counts."""
    bytes_ = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(bytes_) + 1).cast("long").alias("size"), F.crc32(bytes_).alias("text_crc32"))
    rows = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("times"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).drop("times")
    identity = [F.col("doc_id"), F.col("size"), F.col("text_crc32"), F.col("copy")]
    n = docs.count()  # a scalar, from Parquet footers
    n_blocks = 1
    while n_blocks * rows_per_block < n:
        n_blocks *= 2
    rows = rows.withColumns({"r1": F.xxhash64(F.lit(seed), *identity), "r2": F.xxhash64(F.lit(seed + 1), *identity)})
    rows = materialise(rows.withColumn("block", F.pmod(F.col("r1"), F.lit(n_blocks))))  # ids and hashes, read again for the matrix and for both permutations
    matrix = communication_matrix(rows.groupBy("block").agg(F.count("*").alias("n")), n_blocks, n_shards, seed)
    ends = F.transform("share", lambda _, i: F.aggregate(F.slice("share", F.lit(1), i + 1), F.lit(0).cast("long"), lambda a, x: a + x))
    matrix = matrix.select((F.col("node") - n_blocks).alias("block"), ends.alias("ends"))
    local = Window.partitionBy("block").orderBy(F.shiftright("r1", 20), "r2", "doc_id", "size", "text_crc32", "copy")
    placed = rows.withColumn("rank", F.row_number().over(local)).join(matrix, "block")
    placed = placed.withColumn("shard", F.size(F.filter("ends", lambda e: e < F.col("rank"))))
    # second permutation: ranges of r2, about rows_per_block rows in each
    n_ranges = max(1, n_blocks // n_shards + (n_blocks % n_shards > 0))
    width = 2**53 // n_ranges + 1
    placed = placed.withColumn("range", F.floor(F.shiftrightunsigned("r2", 11) / width)).select("doc_id", "size", "text_crc32", "copy", "shard", "range", "r1", "r2")
    before = placed.groupBy("shard", "range").agg(F.count("*").alias("n"))
    before = before.select("shard", "range", (F.sum("n").over(Window.partitionBy("shard").orderBy("range")) - F.col("n")).alias("before"))
    inside = Window.partitionBy("shard", "range").orderBy("r2", "r1", "doc_id", "size", "text_crc32", "copy")
    return (
        placed.withColumn("at", F.row_number().over(inside))
        .join(before, ["shard", "range"])
        .select("doc_id", "size", F.col("text_crc32").cast("long").alias("text_crc32"), F.col("shard").cast("int").alias("shard"), (F.col("before") + F.col("at") - 1).alias("slot"))
    )
