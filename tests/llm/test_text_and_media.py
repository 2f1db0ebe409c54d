import hashlib
import json
import random
import re
import subprocess
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD, frame, prose
from tramline.llm import cotraining, flac, near_dedup, piece_lattice, pieces, shingles
from tramline.llm.queries import PIECE_MODEL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_media(spark, odd, empty):
    media = flac.encode_texts(odd)
    got = {r.doc_id: r for r in flac.digests(media).collect()}
    for i, text, _, _ in ODD:
        raw = (text or "").encode()
        payload = raw + b"\0" * (64 if not raw else -len(raw) % 64)
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        x = [b - 128 for b in payload]
        f = json.loads(r.feature)
        assert (f["samples"], f["peak"], f["sign_changes"], f["bits"], f["frames"]) == (len(x), max(map(abs, x)), sum((a < 0) != (b < 0) for a, b in zip(x, x[1:], strict=False)), 8, -(-len(x) // flac.BLOCK))
        assert abs(f["mean"] - sum(x) / len(x)) < 1e-5 and abs(f["rms"] - (sum(v * v for v in x) / len(x)) ** 0.5) < 1e-5
    assert got[4].media_sha256 == got[5].media_sha256 and got[4].feature == got[5].feature
    blocks = flac.pcm_blocks(media).filter("doc_id = 8").orderBy("block").collect()
    assert [b.first_sample for b in blocks] == list(range(0, 4096 * len(blocks), 4096)) and b"".join(b.pcm for b in blocks) == flac.pad(ODD[8][1].encode())
    assert flac.digests(flac.encode_texts(empty)).count() == 0


@pytest.mark.parametrize("order", [0, 1, 2, 8])
def test_codec(order):
    rng = np.random.default_rng(order)
    wave = (128 + 100 * np.sin(np.arange(9000) / 9)).astype(np.uint8).tobytes()
    payloads = [flac.pad(x) for x in (b"", b"a" * 70, bytes(range(256)) * 33, rng.bytes(4096), rng.bytes(10_000), wave, "é\n".encode() * 4000)]
    streams = flac.encode_many(payloads, order)
    assert [b"".join(b for _, _, b in blocks) for _, blocks in flac.decode_many(streams)] == payloads
    assert len(streams[5]) < len(wave) * 0.8
    for s in streams:  # without the seek table the frames are found too
        info, points, at = flac._metadata(s)
        assert flac._scan(s, at, info) == [at + p[1] for p in points]


@pytest.mark.parametrize("kind", ["constant", "verbatim", "fixed", "lpc"])
def test_wasted_bits(kind):
    """Frames of another encoder: samples whose two low bits are 0 are coded with six bits."""
    rng = np.random.default_rng(4)
    small = np.full(64, -7) if kind == "constant" else np.clip(np.cumsum(rng.integers(-3, 4, 64)), -32, 31)
    bits = lambda v, n: [int(x) for x in np.binary_repr(int(v) & ((1 << n) - 1), n)]
    code = {"constant": 0, "verbatim": 1, "fixed": 9, "lpc": 32}[kind]
    body = [0, *bits(code, 6), 1, 0, 1]  # two wasted bits
    if kind == "constant":
        body += bits(small[0], 6)
    elif kind == "verbatim":
        body += [b for v in small for b in bits(v, 6)]
    else:
        body += bits(small[0], 6) + ([] if kind == "fixed" else [*bits(3, 4), *bits(0, 5), *bits(1, 4)])
        body += [*bits(0, 2), *bits(0, 4), *bits(1, 4)]  # one partition, Rice parameter 1
        for d in np.diff(small).tolist():
            folded = d * 2 if d >= 0 else -d * 2 - 1
            body += [0] * (folded >> 1) + [1, folded & 1]
    frame_ = flac._frame_header(0, 64) + np.packbits(body).tobytes()
    lane = np.frombuffer(frame_, np.uint8)
    frame_ += int(flac.crc16_lanes(lane, np.array([0]), np.array([len(lane)]))[0]).to_bytes(2, "big")
    samples = small * 4
    stream = flac._stream(samples, [frame_])
    assert [b for _, _, b in flac.decode_many([stream])[0][1]] == [(samples + 128).astype(np.uint8).tobytes()]


def test_residuals_of_many_frames_are_read_together(monkeypatch):
    """Codes of all frames at once against a loop over the bits; none of our own frames is read alone, and parts of any size give the same."""
    rng = random.Random(5)
    rows, spans, body = [], [], b""
    for n, k in ((1, 0), (0, 3), (700, 14), (64, 1), (4096, 0), (33, 6)):
        values = [rng.choice((rng.randrange(-(1 << k), 1 << k), rng.randrange(-40, 40))) for _ in range(n)]
        head = rng.randrange(0, 9)
        code = "1" * head
        for v in values:
            folded = v * 2 if v >= 0 else -v * 2 - 1
            code += "0" * (folded >> k) + "1" + (format(folded & ((1 << k) - 1), f"0{k}b") if k else "")
        code += "0" * (-len(code) % 8)
        spans.append((8 * len(body) + head, 8 * len(body) + len(code), k, n))
        body += bytes(int(code[i : i + 8], 2) for i in range(0, len(code), 8))
        rows.append(values)
    data = np.frombuffer(body, np.uint8)
    columns = [np.array(x, np.int64) for x in zip(*spans, strict=True)]
    assert [x.tolist() for x in flac._codes_lanes(data, np.unpackbits(data), *columns)] == rows
    for i in (2, 5):  # a frame inside, and the last one, with one code too many
        more = columns[3].copy()
        more[i] += 1
        with pytest.raises(flac.Damaged, match="out of the frame"):
            flac._codes_lanes(data, np.unpackbits(data), *columns[:3], more)

    def alone(*_):
        raise AssertionError("a frame of our own was read alone")

    monkeypatch.setattr(flac, "_codes", alone)
    payloads = [flac.pad(prose(i, 1 + 900 * i).encode()) for i in range(9)]
    streams = flac.encode_many(payloads)
    for part in (1, 5000, 1 << 20):
        monkeypatch.setattr(flac, "PART", part)
        assert [b"".join(b for _, _, b in blocks) for _, blocks in flac.decode_many(streams)] == payloads


def test_damage():
    s = bytearray(flac.encode(flac.pad(prose(3, 3000).encode())))
    for at in (len(s) // 2, len(s) - 1):
        bad = bytearray(s)
        bad[at] ^= 16
        with pytest.raises(flac.Damaged):
            flac.decode_many([bytes(bad)])


def shingle_set(text, k):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute_components(rows, k, percent):
    sets = {i: shingle_set(t, k) for i, t, *_ in rows}
    root = {i: i for i in sets}
    find = lambda x: x if root[x] == x else find(root[x])
    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(spark, k, percent):
    rng = random.Random(17)
    rows = []
    for g in range(12):
        first = prose(g, rng.choice([3, 8, 30, 120, 400])).split()
        for _ in range(rng.choice([1, 4, 12])):
            w = list(first)
            for _ in range(rng.randrange(0, 1 + len(w) // 20)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(9)}"
            rows.append((len(rows), " ".join(w).upper() if rng.random() < 0.2 else " ".join(w), "en", "s"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.groups(frame(spark, rows), k, percent).collect()}
    assert got == brute_components(rows, k, percent)
    kept = sorted(r.doc_id for r in near_dedup.deduplicated(frame(spark, rows), k, percent).collect())
    assert kept == sorted(i for i, (_, c) in got.items() if i == c)


def test_odd_near_duplicates(spark, odd, empty):
    got = near_dedup.groups(odd.withColumn("doc_id", F.when(F.col("doc_id") != 5, F.col("doc_id")))).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(ODD) and by[None].component_id is None and by[7].component_id == 6 and by[2].component_id == 2 and by[2].n_shingles == 0
    assert near_dedup.groups(empty).count() == 0 and near_dedup.deduplicated(empty).columns == empty.columns


def test_links_below_many_failed_centres(spark):
    """Texts of one template at 0.83 share buckets without a link; pairs at 0.86 among them are found whichever members fail first."""
    template = [f"t{i}" for i in range(402)]
    own = lambda i, n: [f"u{i}x{j}" for j in range(n)]
    text = lambda i: " ".join(template + (own(1000 + i // 2, 9) + own(i, 32) if i < 40 else own(i, 41)))
    rows = [(i, text(i), "en", "s") for i in range(120)]
    expected = brute_components(rows, 3, 85)
    assert sum(expected[i][1] != i for i in range(120)) == 20
    got = {r.doc_id: r.component_id for r in near_dedup.groups(frame(spark, rows), 3, 85).collect()}
    assert got == {i: x[1] for i, x in expected.items()}


def near_threshold(common, pair, own, n):
    """Texts of one template with pairs among them: ``common`` shared words, and for the first 400 texts ``pair`` words shared with one other."""
    template = [f"t{i}" for i in range(common)]
    words = lambda i, k: [f"u{i}x{j}" for j in range(k)]
    return [(i, " ".join(template + (words(10_000 + i // 2, pair) + words(i, own - pair) if i < 400 else words(i, own))), "en", "s") for i in range(n)]


@pytest.mark.parametrize(("common", "pair", "own"), [(402, 5, 38), (402, 4, 37), (402, 9, 41)])
def test_links_just_above_the_threshold(spark, common, pair, own):
    """200 pairs at 0.86 among 600 texts that are at 0.83 to 0.845 with each other: no link is lost."""
    rows = near_threshold(common, pair, own, 600)
    one, two, far = (shingle_set(rows[i][1], 3) for i in (0, 1, 2))
    jaccard = lambda x, y: len(x & y) / len(x | y)
    assert jaccard(one, two) >= 0.85 > jaccard(one, far) > 0.82
    got = {r.doc_id: r.component_id for r in near_dedup.groups(frame(spark, rows), 3, 85).collect()}
    assert got == {i: i - i % 2 if i < 400 else i for i in range(600)}


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_random_edits_of_one_text(spark, k, percent):
    """Near copies with up to 14 edits, and copies of copies, against all pairs."""
    rng = random.Random(k)
    texts = [[f"w{rng.randrange(500)}" for _ in range(150)]]
    for _ in range(400):
        w = list(texts[0] if rng.random() < 0.7 else rng.choice(texts))
        for _ in range(rng.randrange(0, 15)):
            at = rng.randrange(len(w))
            kind = rng.random()
            if kind < 0.5:
                w[at] = f"e{rng.randrange(50)}"
            elif kind < 0.8:
                del w[at]
            else:
                w.insert(at, f"w{rng.randrange(500)}")
        texts.append(w)
    rows = [(i, " ".join(w), "en", "s") for i, w in enumerate(texts)]
    expected = brute_components(rows, k, percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.groups(frame(spark, rows), k, percent).collect()}
    assert got == expected and len({c for _, c in expected.values()}) > 20


def test_members_without_common_differences_never_meet(spark):
    """A star of 300 texts that are at 0.83 with each other gives a few candidates, not all pairs."""
    rows = near_threshold(402, 0, 41, 300)[:300]
    sets = [(i, i, sorted(hash(x) for x in shingle_set(t, 3))) for i, t, *_ in rows]
    sets = spark.createDataFrame(sets, "node long, rep long, shingles array<long>")
    stars = spark.createDataFrame([(i, 0, len(shingle_set(rows[i][1], 3)), i, False) for i in range(1, 300)], "x long, centre long, n int, root long, inside boolean")
    assert near_dedup.large_pairs(stars, sets, 85).count() == 0


def test_shingles_match_words():
    texts = [t.encode() for t in ("A b\tc a B C", "a", "", "x " * 50)]
    sets = list(shingles.shingle_sets(texts, 3))
    assert [len(s) for s in sets] == [len(shingle_set(t.decode(), 3)) for t in texts]


@pytest.fixture(scope="module")
def vocabulary():
    with open(PIECE_MODEL, "rb") as f:
        return piece_lattice.Vocabulary(f.read())


def enumerate_all(v, text):
    known = {p: i for i, p in enumerate(v.pieces) if v.log_p[i]}

    def tails(s):
        if not s:
            yield ()
        for n in range(1, len(s) + 1):
            if s[:n] in known:
                yield from ((known[s[:n]], *r) for r in tails(s[n:]))

    found = {x: float(sum(v.log_p[i] for i in x)) for x in tails("▁" + text.replace(" ", "▁"))}
    total = np.log(sum(np.exp(x) for x in found.values()))
    return {k: x - total for k, x in found.items()}


def test_sampling_law(vocabulary):
    exact = enumerate_all(vocabulary, "a hat")
    n, k = 4000, 3
    out = piece_lattice.sample(piece_lattice.Lattices(vocabulary), ["a hat"] * n, shingles.mix(np.arange(n, dtype=np.uint64)), k)
    assert all(len({tuple(r[0]) for r in x}) == k and x[0][2] >= x[1][2] >= x[2][2] for x in out)
    assert all(abs(r[1] - exact[tuple(r[0].tolist())]) < 1e-5 for x in out for r in x)
    first = Counter(tuple(x[0][0].tolist()) for x in out)
    second = Counter((tuple(x[0][0].tolist()), tuple(x[1][0].tolist())) for x in out)
    weight = defaultdict(float)
    for x in out:
        for ids, log_p, _, q in x:
            weight[tuple(ids.tolist())] += np.exp(log_p - q) / n
    for s, log_p in exact.items():
        p = np.exp(log_p)
        assert abs(first[s] / n - p) < 0.03
        assert p < 0.02 or abs(weight[s] - p) < 0.03  # inclusion probabilities make the estimate unbiased
        for t, log_q in exact.items():
            if s != t:
                assert abs(second[s, t] / n - p * np.exp(log_q) / (1 - p)) < 0.03


def test_few_segmentations(vocabulary):
    rows = piece_lattice.sample(piece_lattice.Lattices(vocabulary), ["\n", ""], np.array([1, 2], np.uint64), 50)
    assert len({tuple(r[0]) for r in rows[0]}) == len(rows[0]) == len(enumerate_all(vocabulary, "")) and all(r[3] == 0.0 for r in rows[0])


def test_pieces(spark, odd, empty):
    out = pieces.encode(odd, PIECE_MODEL)
    rows = out.collect()
    assert all(r.round_trip and -1e9 < r.log_inclusion <= 0 and len(r.ids) == r.n_pieces for r in rows)
    texts = dict((i, t or "") for i, t, *_ in ODD)
    assert all(r.text == texts[r.doc_id] for r in pieces.decode(out, PIECE_MODEL).collect())
    assert {r.doc_id for r in rows} == set(texts) and [r.sample for r in rows if r.doc_id == 8] == [1, 2]
    assert sorted(map(str, rows)) == sorted(map(str, pieces.encode(odd.repartition(3), PIECE_MODEL).collect()))
    assert pieces.encode(empty, PIECE_MODEL).count() == 0


def labelled(n, seed=0):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        text = prose(seed + i, rng.randrange(20, 150))
        rows.append((i, text if good else " ".join(w.upper() + rng.choice(["!!", "***"]) for w in text.split()), rng.choice(["en", "de"]), rng.choice("abc")))
        labels.append((i, int(good), 0))
    return rows, labels


def test_co_training(spark, odd, empty):
    rows, labels = labelled(500)
    known = spark.createDataFrame(labels[:250], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in cotraining.judge(frame(spark, rows), known).collect()}
    held = [i for i in range(250, 500)]
    assert sum(got[i].kept == bool(labels[i][1]) for i in held) >= 0.97 * len(held)
    assert all(got[i].kept for i in held if labels[i][1]) and all(0 < r.score < 1 for r in got.values())
    docs = frame(spark, rows)
    assert cotraining.kept(docs, known).columns == docs.columns
    assert cotraining.judge(odd, known).filter("score is null").count() == 0
    assert cotraining.judge(empty, known).count() == 0
    none = known.limit(0)
    assert cotraining.judge(odd, none).filter("kept and score = 1.0").count() == len(ODD)
    odd_labels = spark.createDataFrame([(1, None, None), (None, 1, 0), (6, 1, 0), (6, 0, 0)], "doc_id long, quality int, toxic int")
    assert cotraining.judge(odd, odd_labels).count() == len(ODD)


def test_co_training_views_teach(monkeypatch):
    """A view without a clue in the labels learns from the other's pseudo-labels."""
    rng = np.random.default_rng(1)
    n = 1200
    y = (rng.random(n) < 0.6).astype(int)
    text = np.hstack([y[:, None] + rng.normal(0, 0.2, (n, 1)), np.ones((n, 1))]).astype(np.float32)
    seen = np.arange(n) < 200
    # the second column of the page view says all, but is missing in labelled rows
    page = np.column_stack([y + rng.normal(0, 0.6, n), np.where(seen, 0.5, y)]).astype(np.float32)
    given, rest = (text[seen], page[seen], y[seen], (np.arange(n) % 3 == 0)[seen]), (text[~seen], page[~seen], np.arange((~seen).sum()) % 5)
    model = cotraining.train(*given, lambda w, c: cotraining.handed_on(w, c, *rest))
    alone = cotraining.train(*given, lambda w, c: {})
    assert model["handed"] > 100 and alone["handed"] == 0
    right = lambda m: (((cotraining.raw(rest[1], m["weights"][1])) > 0) == y[~seen]).mean()
    assert right(model) > right(alone) + 0.03
    score = cotraining.apply(model, text, page)[2]
    assert ((score > 0.5) == y)[200:].mean() > 0.97


def test_every_unlabelled_document_takes_part(spark):
    """The exchange counts all documents beyond the labelled sample, and sums don't depend on partitions."""
    rows, labels = labelled(600)
    docs = frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    rng = np.random.default_rng(3)
    model = [rng.normal(0, 0.1, d + 1).astype(np.float32) for d in (cotraining.TEXT_DIMENSIONS, cotraining.PAGE_DIMENSIONS)], [np.array([0.0, 9.0])] * 2  # sure of everything
    one, two = (cotraining.exchanged(docs.repartition(p), *model) for p in (1, 7))
    assert sum(n for (view, _, _), (n, _) in one.items() if view == 0) == 600 and one.keys() == two.keys()
    assert all(one[k][0] == two[k][0] and (one[k][1] == two[k][1]).all() for k in one)


def test_held_out_accuracy(spark):
    """Fitted on half of the labels of the test tables and right on the other half."""
    base = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    half = labels.filter("doc_id % 2 = 0")
    got = cotraining.judge(docs, half).join(labels.filter("doc_id % 2 = 1 and quality is not null"), "doc_id").select("kept", "quality").collect()
    assert sum(r.kept == (r.quality == 1) for r in got) >= 0.97 * len(got)


WORKER = """
import random, re, sys
from pathlib import Path
import pyarrow as pa
from tramline.llm import pieces
from tramline.llm.queries import PIECE_MODEL

def mb(name):
    return sum(int(x) for x in re.findall(rf"\\n{name}:\\s+(\\d+) kB", Path("/proc/self/status").read_text())) / 1024

rng = random.Random(5)
words = ["".join(rng.choices("etaoinshrdlucmfw", k=rng.randint(3, 12))) for _ in range(60_000)]
batches = [pa.record_batch({"id": list(range(k * 500, k * 500 + 500)), "text": [" ".join(rng.choices(words, k=600)) for _ in range(500)]}) for k in range(2)]
model = Path(PIECE_MODEL).read_bytes()
peak, held = mb("VmHWM"), mb("RssAnon")
rows = sum(b.num_rows for b in pieces.encoded(iter(batches), model))
print(rows, mb("VmHWM") - peak, mb("RssAnon") - held)
"""


def test_a_worker_that_samples_pieces_stays_small():
    """Two workers and a full heap share an executor: neither a batch of long texts nor what is left after a task may take much."""
    out = subprocess.run([sys.executable, "-c", WORKER], cwd=Path(__file__).parents[2], capture_output=True, text=True, timeout=120, check=True)
    rows, peak, held = map(float, out.stdout.split())
    assert rows == 2000 and peak < 170 and held < 90


def test_pieces_do_not_depend_on_the_texts_sampled_together(monkeypatch):
    batch = lambda: iter([pieces.pa.record_batch({"id": list(range(40)), "text": [prose(k, 300) for k in range(40)]})])
    model = Path(PIECE_MODEL).read_bytes()
    every = []
    for size in (1, 5000, 1 << 20):
        monkeypatch.setattr(pieces, "TEXT_BYTES", size)
        every.append([r for b in pieces.encoded(batch(), model) for r in b.to_pylist()])
    assert every[0] == every[1] == every[2] and len(every[0]) == 80
