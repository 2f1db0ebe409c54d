import random
import re
import zlib
from collections import Counter, defaultdict
from math import comb

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD, frame, prose
from tramline.llm import mixing, quality_rules, sharding
from tramline.llm.common import unit_interval

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = {i + k for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for k in range(8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_base_rules(spark, odd, empty):
    got = quality_rules.judge(odd).collect()
    assert len(got) == len(ODD)
    by = {r.doc_id: r for r in got}
    for i, text, _, _ in ODD:
        r = by[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base(text), i
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
    assert quality_rules.judge(empty).count() == 0 and quality_rules.clean(empty).count() == 0


def test_repeats_fuzz(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 40))), "en", "s") for i in range(150)]
    got = {r.doc_id: r.n_repeat_words for r in quality_rules.judge(frame(spark, rows)).collect()}
    assert got == {i: base(t)[4] for i, t, _, _ in rows}


def test_frequent_lines(spark):
    notice = "Subscribe to our letter now and never miss a thing again my dear reader"
    rows = [(i, f"{prose(i, 6)}\n{notice}\n{prose(i + 1000, 6)}", "en", "hot") for i in range(30)]  # 12 own words: depleted without the notice
    rows += [(100 + i, f"{notice.upper()}  \n{prose(i + 2000, 80)}", "en", "hot") for i in range(10)]  # long enough
    rows += [(200 + i, f"{prose(5000, 30)}\n{prose(5001, 10)}", "en", "hot") for i in range(60)]  # copies are no boilerplate
    rows += [(300 + i, f"{prose(i + 3000, 8)}\n{notice}\n{prose(i + 4000, 9)}", "en", "cold") for i in range(15)]  # rare on its host
    docs = frame(spark, rows)
    kept = {r.doc_id: (r.kept, r.n_removed) for r in quality_rules.judge(docs).collect()}
    assert all(kept[i] == (False, 14) for i in range(30))
    assert all(kept[100 + i] == (True, 14) for i in range(10))
    assert all(kept[200 + i] == (True, 0) for i in range(60))
    assert all(kept[300 + i] == (True, 0) for i in range(15))
    cleaned = quality_rules.clean(docs)
    assert cleaned.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    texts = {r.doc_id: (r.text, r.n_chars) for r in cleaned.collect()}
    assert texts[103] == (prose(2003, 80), len(prose(2003, 80))) and texts[305][0] == rows[-10][1] and len(texts) == 85


def test_documents_of_one_template_are_counted(spark):
    """Different documents never count as one, also where a page has many shared lines or one line only."""
    shared = [prose(7000 + k, 5) for k in range(10)]
    rows = [(i, "\n".join([*shared, prose(i, 40)]), "en", "hot") for i in range(100)]
    rows += [(200 + i, shared[0], "en", "one") for i in range(30)] + [(300 + i, f"{shared[0]}\n{prose(i, 40)}", "en", "one") for i in range(20)]  # 21 texts
    got = {r.doc_id: r.n_removed for r in quality_rules.judge(frame(spark, rows)).collect()}
    assert all(got[i] == 50 for i in range(100)) and all(got[i] == 5 for i in range(200, 320) if i in got)


def test_long_lines_are_counted(spark):
    passage = prose(8000, 60)
    rows = [(i, f"{passage}\n{prose(i, 40)}", "en", "hot") for i in range(30)] + [(100 + i, f"{passage}\n{prose(9000, 30)}", "en", "cold") for i in range(60)]
    got = {r.doc_id: (r.kept, r.n_removed) for r in quality_rules.judge(frame(spark, rows)).collect()}
    assert all(got[i] == (True, 60) for i in range(30)) and all(got[100 + i] == (True, 0) for i in range(60))  # copies aren't counted


def expected_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in full]
        left = total - sum(3 * sizes[s] for s in full)
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = {s for s in rest if share[s] > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in full else share[s] for s in order}
        full |= over


def test_mix(spark, odd, empty):
    rng = random.Random(3)
    rows = [(i, prose(i, rng.randrange(1, 200)), "en", rng.choice(["a", "b", "b", "b", "b", "B", "ä", None])) for i in range(600)]
    docs = frame(spark, rows)
    got = mixing.mix(docs).collect()
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len(WORD.findall(t))
    target, source, taken = expected_targets(sizes), {r[0]: r[3] for r in rows}, defaultdict(int)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - target[s]) < 1e-6 * target[s]
        assert 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 2 * mixing.BLOCK_WORDS for s in sizes)
    assert sorted(got) == sorted(mixing.mix(docs.repartition(7)).collect())
    shards = mixing.mix(docs, shard_words=700, block_words=16)
    by = {r.source: r.x for r in shards.join(docs.select(F.col("doc_id").alias("d"), "source"), F.col("doc_id") == F.col("d")).groupBy("source").agg(F.sum("taken").alias("x")).collect()}
    assert all(abs(by[s] - target[s]) <= 2 * 16 + 0.001 * target[s] for s in sizes)
    words = defaultdict(int)
    for r in mixing.mixed(docs).collect():
        words[r.doc_id] += len(WORD.findall(r.text))
        assert r.text in dict((x[0], x[1]) for x in rows)[r.doc_id] and r.n_chars == len(r.text)
    assert words == {r.doc_id: r.taken for r in got if r.taken}
    assert mixing.mix(odd).count() == len(ODD) and mixing.mixed(odd).columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert mixing.mix(odd).filter("doc_id = 1 and size = 0 and taken = 0").count() == 1
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0


def test_sainte_lague(spark):
    rng = random.Random(8)
    rows, expected = [], {}
    for g in range(30):
        weights = [rng.choice([0.0, 1.0, rng.random() * 100, 1000.0]) for _ in range(rng.randrange(1, 12))]
        n, won = rng.randrange(0, 60), [0] * len(weights)
        for _ in range(n if sum(weights) else 0):
            best = max(range(len(weights)), key=lambda i: (weights[i] / (2 * won[i] + 1), -i))
            won[best] += 1
        rows += [(g, i, w, n) for i, w in enumerate(weights)]
        expected |= {(g, i): x for i, x in enumerate(won)}
    df = spark.createDataFrame(rows, "g int, i int, w double, n long")
    got = {(r.g, r.i): r.x for r in mixing.sainte_lague(df, ["g"], "i", "w", "n", "x").collect()}
    assert got == expected


def test_hypergeometric(spark):
    df = spark.range(8000).select(sharding.hypergeometric(*[F.lit(x).cast("long") for x in (60, 25, 18)], unit_interval(5, F.col("id"))).alias("x"))
    got = {r.x: r["count"] / 8000 for r in df.groupBy("x").count().collect()}
    assert all(abs(got.get(k, 0) - comb(25, k) * comb(35, 18 - k) / comb(60, 18)) < 0.02 for k in range(19))
    edge = [(0, 0, 0, 0), (5, 5, 3, 3), (5, 0, 3, 0), (7, 4, 7, 4)]
    at = spark.createDataFrame(edge, "t long, g long, d long, x long").withColumn("got", sharding.hypergeometric(F.col("t"), F.col("g"), F.col("d"), F.lit(0.3)))
    assert at.filter("got <> x").count() == 0


@pytest.mark.parametrize("per_block", [50_000, 40])
def test_shards(spark, odd, per_block):
    rows = [(i, prose(i, 3) if i % 5 else None, "en", "s") for i in range(203)]
    got = sharding.shuffled(frame(spark, rows), 16, rows_per_block=per_block).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert len(got) == 203 and sorted(map(len, slots.values())) == [12] * 5 + [13] * 11 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all((r.size, r.text_crc32) == (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for r in got for t in [rows[r.doc_id][1]])
    assert sorted(got) == sorted(sharding.shuffled(frame(spark, rows).repartition(5), 16, rows_per_block=per_block).collect())
    assert sharding.shuffled(odd, 4, rows_per_block=per_block).count() == len(ODD)


def test_repeated_rows_are_shuffled_apart(spark):
    rows = [(i, prose(i, 3), "en", "s") for i in range(1000)] * 2 + [(5000, "hot", "en", "s")] * 800 + [(None, None, None, None)] * 3
    docs = frame(spark, rows)
    got = sharding.shuffled(docs).collect()
    shards, slots = defaultdict(list), defaultdict(list)
    for r in got:
        shards[r.doc_id].append(r.shard)
        slots[r.shard].append(r.slot)
    assert sorted(Counter(r.doc_id for r in got).values()) == sorted(Counter(r[0] for r in rows).values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert 30 < sum(len(set(v)) == 1 for k, v in shards.items() if k is not None and k < 1000) < 100  # 62.5 of 1000 by chance
    assert all(25 <= n <= 80 for n in Counter(shards[5000]).values()) and len(set(shards[5000])) == 16
    # a uniform permutation: over seeds, every row meets every shard about equally often
    met = Counter((r.doc_id, r.shard) for seed in range(15) for r in sharding.shuffled(frame(spark, rows[:8]), 4, seed=seed, rows_per_block=3).collect())
    assert all(met[i, s] in range(0, 13) for i in range(8) for s in range(4))


def test_no_rows_to_shard(spark, empty):
    assert sharding.shuffled(empty).count() == 0


def test_matrix_margins(spark):
    sizes = spark.createDataFrame([(b, 37 + 5 * b) for b in range(7)], "block long, n long")
    m = {r.node - 8: r.share for r in sharding.communication_matrix(sizes, 8, 5, 3).collect()}
    assert [sum(m[b]) for b in range(8)] == [37 + 5 * b for b in range(7)] + [0]
    total = sum(37 + 5 * b for b in range(7))
    assert sorted(sum(m[b][s] for b in range(8)) for s in range(5)) == sorted(total // 5 + (s < total % 5) for s in range(5))
