"""Mixing sources to target weights by Sainte-Lague apportionment. DataFrame functions only.

1. Targets. Sources in code point order (null last) weigh 1, 2, 3, repeating, and share all words of the corpus; a target stops at
   ``max_epochs`` times its source's words, and the excess is shared again by weight until none is above (closed form over a sort by
   the ratio of cap and weight).
2. Quotas. The corpus is worth n blocks of ``block_words`` words. Sources get blocks by the highest quotients weight / (2 seats + 1);
   a source's blocks go to its shards in the same way, by the shards' words. The number of shards of a source follows its words, so
   a hot source is many shards. Apportionment starts from the rounding at a divisor that is surely too large and adds the few
   missing seats by quotient, so its cost follows the number of parties and not the number of blocks.
3. Selection. A shard's documents stand in a seeded random order and form a ring of words cut into blocks. Whole rounds are taken as
   often as the quota holds them; the rest is a run of blocks from a seeded starting block. Only the documents at the ends of
   that run are taken in part.

Defined results: null or empty text has size 0 and takes 0; a source without words gets target 0; repeated rows count
each; rows with a null id stand at one place of the order and in one shard; rows with equal ids and sizes stand in no order among themselves, so of
their texts any may be the one that is taken in part; texts of any length are read whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm.common import BLANK, words_of

BLOCK_WORDS = 64
SHARD_WORDS = 2_000_000
MAX_EPOCHS = 3
SEED = 7


def targets(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> adds weight and target. One row a source."""
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    ranked = ranked.withColumn("weight", ((F.col("rank") - 1) % 3 + 1).cast("double")).withColumn("cap", F.col("source_size").cast("double") * max_epochs)
    every = Window.partitionBy()
    rising = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumns({"all_words": F.sum("source_size").over(every), "all_weight": F.sum("weight").over(every)})
    ranked = ranked.withColumns({"caps_before": F.coalesce(F.sum("cap").over(rising), F.lit(0.0)), "weight_before": F.coalesce(F.sum("weight").over(rising), F.lit(0.0))})
    ranked = ranked.withColumn("full", F.col("cap") <= F.col("weight") * (F.col("all_words") - F.col("caps_before")) / (F.col("all_weight") - F.col("weight_before")))
    taken = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(every)
    open_ = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(every)
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * (F.col("all_words") - taken) / open_)
    return ranked.select("source", "source_size", "rank", "weight", "all_words", target.alias("target"))


def sainte_lague(parties: DataFrame, within: list[str], order: str, weight: str, seats: str, out: str) -> DataFrame:
    """Adds ``out``: the seats of each party of the group ``within``, by highest quotients; ties go to the smaller ``order``."""
    group = Window.partitionBy(*within)
    df = parties.withColumns({"_w": F.sum(weight).over(group), "_k": F.count("*").over(group)})
    sure = F.floor(F.col(weight) * F.greatest(F.lit(0.0), F.col(seats) - F.col("_k") / 2) / F.col("_w") + 0.5).cast("long")
    df = df.withColumn("_sure", F.when(F.col("_w") > 0, sure).otherwise(F.lit(0)).cast("long"))
    df = df.withColumn("_open", F.when(F.col("_w") > 0, F.col(seats) - F.sum("_sure").over(group)).otherwise(F.lit(0)))
    # no party can win more of the open seats than this
    most = F.when(F.col("_w") > 0, F.ceil(F.col(weight) / F.col("_w") * (F.col("_open") + F.col("_k"))) + 1).otherwise(F.lit(1)).cast("long")
    bids = df.select(*within, F.col(order).alias("_order"), F.col("_open").alias("_o"), (F.col(weight)).alias("_v"), F.col("_sure").alias("_s"), F.explode(F.sequence(F.lit(0).cast("long"), most - 1)).alias("_j"))
    best = Window.partitionBy(*within).orderBy((F.col("_v") / (2 * (F.col("_s") + F.col("_j")) + 1)).desc(), "_order", "_j")
    won = bids.withColumn("_place", F.row_number().over(best)).filter(F.col("_place") <= F.col("_o"))
    won = won.groupBy(*[F.col(c).alias(f"_g_{c}") for c in within], "_order").agg(F.count("*").alias("_won"))
    on = F.col(order) == F.col("_order")
    for c in within:
        on = on & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    df = df.join(won, on, "left").withColumn(out, F.col("_sure") + F.coalesce("_won", F.lit(0)))
    return df.select(*parties.columns, out)


def number(hexed: Column) -> Column:
    return F.conv(F.substring(hexed, 1, 8), 16, 10).cast("long")


def ring(docs: DataFrame, carry: list[str] = [], block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:  # noqa: B006
    """One row per document with rounds, and the word ranges [a0, a1) and [b0, b1) of the partial round that fall on it."""
    own = docs.select("doc_id", "source", *carry, F.size(words_of(F.col("text"))).cast("long").alias("size"))
    sources = targets(own.groupBy("source").agg(F.sum("size").alias("source_size")), max_epochs)
    sources = sources.withColumn("all", F.lit(0)).withColumn("blocks", F.round(F.col("all_words") / block_words).cast("long"))
    sources = sainte_lague(sources, ["all"], "rank", "target", "blocks", "quota")
    sources = sources.withColumn("n_shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long"))
    src = sources.select(F.col("source").alias("s_source"), "source_size", "target", F.col("rank").cast("long").alias("src"), "quota", "n_shards")
    own = own.join(src, F.col("source").eqNullSafe(F.col("s_source"))).drop("s_source")
    own = own.withColumn("at", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    own = own.withColumn("shard", F.pmod(number(F.col("at")), F.col("n_shards")))
    shards = own.groupBy("src", "shard").agg(F.sum("size").alias("words"), F.first("quota").alias("quota"))
    shards = sainte_lague(shards.withColumn("v", F.col("words").cast("double")), ["src"], "shard", "v", "quota", "blocks")
    taken = F.least(F.col("blocks") * block_words, F.col("words") * max_epochs)
    shards = shards.withColumn("take", taken).withColumn("rounds", F.when(F.col("words") > 0, F.floor(F.col("take") / F.col("words"))).otherwise(0).cast("long"))
    first = number(F.md5(F.concat(F.lit(f"{seed}:"), F.col("src").cast("string"), F.lit(":"), F.col("shard").cast("string"))))
    shards = shards.select(
        F.col("src").alias("h_src"), F.col("shard").alias("h_shard"), "words", "rounds", (F.col("take") - F.col("rounds") * F.col("words")).alias("rest"),
        (F.pmod(first, F.greatest(F.lit(1), F.ceil(F.col("words") / block_words)).cast("long")) * block_words).alias("start"),
    )
    order = Window.partitionBy("src", "shard").orderBy("at", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    own = own.withColumn("end", F.sum("size").over(order)).withColumn("begin", F.col("end") - F.col("size"))
    own = own.join(shards, (F.col("src") == F.col("h_src")) & (F.col("shard") == F.col("h_shard")))
    stop = F.col("start") + F.col("rest")
    inside = lambda x: F.least(F.greatest(x - F.col("begin"), F.lit(0)), F.col("size")).cast("long")
    return own.withColumns(
        {"a0": inside(F.col("start")), "a1": inside(F.least(stop, F.col("words"))), "b1": inside(stop - F.col("words"))}
    ).withColumn("taken", F.col("rounds") * F.col("size") + F.col("a1") - F.col("a0") + F.col("b1"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken): the words that the mix takes of every document."""
    return ring(docs, **options).select("doc_id", "size", "source_size", "target", "taken")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, in the columns of ``docs``: a row for each whole round of a document and for each part of one.

    A part keeps the words' own blanks. Documents of which nothing is taken are left out, which is the mix's decision.
    """
    rows = ring(docs, carry=["text", "lang", "n_chars"], **options).filter("taken > 0")
    whole = lambda: F.struct(F.lit(0).cast("long").alias("p"), F.col("size").alias("q"))
    parts = F.concat(
        F.transform(F.sequence(F.lit(1).cast("long"), F.greatest(F.col("rounds"), F.lit(1))), lambda _: whole()),
        F.array(F.struct(F.col("a0").alias("p"), F.col("a1").alias("q")), F.struct(F.lit(0).cast("long").alias("p"), F.col("b1").alias("q"))),
    )
    parts = F.when(F.col("rounds") > 0, parts).otherwise(F.slice(parts, 2, 2))
    rows = rows.withColumn("part", F.explode(F.filter(parts, lambda x: x["q"] > x["p"])))
    pieces = F.split("text", f"(?<=[^{BLANK}])(?=[{BLANK}])")
    text = F.when((F.col("part.p") == 0) & (F.col("part.q") == F.col("size")), F.col("text")).otherwise(
        F.array_join(F.slice(pieces, (F.col("part.p") + 1).cast("int"), (F.col("part.q") - F.col("part.p")).cast("int")), "")
    )
    rows = rows.select("doc_id", text.alias("text"), "lang", "source")
    return rows.withColumn("n_chars", F.length("text").cast("long"))


ORACLE_SQL = f"""
WITH own AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
  md5(concat('{SEED}:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS pick FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS src FROM own GROUP BY source),
w AS (SELECT *, CAST((src - 1) % 3 + 1 AS DOUBLE) AS weight, {MAX_EPOCHS} * CAST(source_size AS DOUBLE) AS cap, (SELECT sum(size) FROM own) AS t FROM src),
-- a source is full at the common level x when cap <= weight * x; levels are tried at every cap
lv AS (SELECT c.src, c.cap / c.weight AS x, (SELECT sum(least(w.cap, w.weight * (c.cap / c.weight))) FROM w) AS filled FROM w c),
fu AS (SELECT w.*, lv.filled <= w.t AS is_full FROM w JOIN lv USING (src)),
tg AS (SELECT *, CASE WHEN is_full THEN cap ELSE weight * (t - (SELECT coalesce(sum(cap), 0) FROM fu WHERE is_full)) / (SELECT sum(weight) FROM fu WHERE NOT is_full) END AS target FROM fu),
bid AS (SELECT src, target / (2 * j + 1) AS v FROM (SELECT src, target, t, unnest(range(CAST(round(t / {BLOCK_WORDS}) AS BIGINT))) AS j FROM tg) x),
won AS (SELECT src, count(*) AS quota FROM (SELECT src, row_number() OVER (ORDER BY v DESC, src) AS p FROM bid) x WHERE p <= (SELECT max(round(t / {BLOCK_WORDS})) FROM tg) GROUP BY src),
sq AS (SELECT tg.*, coalesce(quota, 0) AS quota, greatest(1, CAST(ceil(source_size / {SHARD_WORDS}) AS BIGINT)) AS n_shards FROM tg LEFT JOIN won USING (src)),
d AS (SELECT own.*, sq.src, sq.source_size, sq.target, sq.quota, CAST(concat('0x', substr(pick, 1, 8)) AS BIGINT) % n_shards AS shard FROM own JOIN sq ON own.source IS NOT DISTINCT FROM sq.source),
sh AS (SELECT src, shard, sum(size) AS words, max(quota) AS quota FROM d GROUP BY src, shard),
bid2 AS (SELECT src, shard, quota, words / (2 * j + 1) AS v FROM (SELECT *, unnest(range(CAST(quota AS BIGINT))) AS j FROM sh) x),
won2 AS (SELECT src, shard, count(*) AS blocks FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY v DESC, shard) AS p FROM bid2) x WHERE p <= quota GROUP BY src, shard),
tk AS (SELECT sh.*, least(coalesce(blocks, 0) * {BLOCK_WORDS}, words * {MAX_EPOCHS}) AS take,
  CAST(concat('0x', substr(md5(concat('{SEED}:', CAST(src AS VARCHAR), ':', CAST(shard AS VARCHAR))), 1, 8)) AS BIGINT) % greatest(1, CAST(ceil(words / {BLOCK_WORDS}) AS BIGINT)) * {BLOCK_WORDS} AS start
  FROM sh LEFT JOIN won2 USING (src, shard)),
rd AS (SELECT *, CASE WHEN words > 0 THEN take // words ELSE 0 END AS rounds FROM tk),
p AS (SELECT d.*, words, rounds, start, take - rounds * words AS rest, sum(size) OVER (PARTITION BY d.src, d.shard ORDER BY pick, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS b FROM d JOIN rd USING (src, shard))
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
 CAST(rounds * size + greatest(0, least(b + size, start + rest, words) - greatest(b, start)) + greatest(0, least(b + size, start + rest - words) - b) AS BIGINT) AS taken FROM p
"""
