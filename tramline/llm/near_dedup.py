"""Near-duplicate groups by one-permutation MinHash, banded buckets and star-shaped candidate edges, confirmed on full sets.

1. Every whole text becomes its set of k-word shingle hashes; documents with equal sets are one class, represented by its smallest id.
2. A class's one-permutation signature is cut into bands; classes that agree on a band share a bucket.
3. A bucket yields a star, not all pairs: its centre is the member that shares buckets with the most others (near a group's
   original), and each other member is compared with the centre only. Candidate edges are thus fewer than bucket entries.
4. Edges are confirmed by exact Jaccard similarity of the full sets, and confirmed links are merged to components.
5. The rest of a star is settled exactly. Where the members around a centre (over all of its buckets) belong to several components, small stars
   compare the members of different components directly. Large ones describe each member by its difference to the centre. Two members are
   alike only if their differences overlap so much that the rarest elements of both must hold a common one (prefix filter, with its bound on
   positions), so only members that share such an element are compared. Members whose differences have nothing in common never meet,
   however many there are. Candidates of both kinds are confirmed on full sets again.

So every pair of a bucket is in one component already, or compared, or proven to be no link; a link is missed only if its ends share no band and no path
of other links joins them.

Defined results: null or empty texts, and texts of blanks, have no shingles and stand alone; documents without an id take no part in links and
get no component; rows with the same id are one document; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm import minhash
from tramline.llm.common import materialise, ship
from tramline.operators.components import components
from tramline.llm.shingles import U, chunks, mix, shingle_sets

K = 5
PERCENT = 80
#: Members beside one copy of their centre's set.
PER_COPY = 256
#: Around a centre with no more members than this, members are compared directly: at most 3.5 pairs a member.
SMALL_STAR = 8


def class_key(shingles: np.ndarray) -> int:
    """64-bit key of a set, as a signed number."""
    if not len(shingles):
        return 0
    one, two = (x.sum(dtype=np.uint64, keepdims=True) for x in (mix(shingles * U(0x9FB21C651E98DF25)), mix(shingles)))  # arrays wrap around silently
    return int((one ^ two * U(3)).astype(np.int64)[0])


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate(rows).astype(np.int64) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _per_set(k: int, columns):
    """mapInArrow function: ``columns(sets)`` gives the columns that replace the text (second column)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            at = 0
            for part in chunks(texts):
                made = columns(list(shingle_sets(part, k)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), *made.values()], names=["doc_id", *made])
                at += len(part)

    return run


def _signed(sets: list[np.ndarray]) -> dict[str, pa.Array]:
    none = np.zeros(0, U)
    return {
        "n": pa.array([len(s) for s in sets], pa.int64()),
        "node": pa.array([class_key(s) for s in sets], pa.int64()),
        "bands": _lists([minhash.bands(s) if len(s) else none for s in sets]),
    }


def _full(sets: list[np.ndarray]) -> dict[str, pa.Array]:
    return {"node": pa.array([class_key(s) for s in sets], pa.int64()), "shingles": _lists(sets)}


def beside_centres(stars: DataFrame, sets: DataFrame) -> DataFrame:
    """(x, centre, a, b, sx, sy): the sets and smallest ids of each member ``x`` and its ``centre``.

    A centre may have a third of all classes around it, so its row is copied once for every PER_COPY members and members are dealt over the copies.
    """
    left = sets.select(F.col("node").alias("x"), F.col("rep").alias("a"), F.col("shingles").alias("sx"))
    copies = stars.groupBy(F.col("centre").alias("node")).agg(F.ceil(F.count("*") / PER_COPY).cast("int").alias("copies"))
    right = sets.join(copies, "node").select(F.col("node").alias("centre"), F.col("rep").alias("b"), F.col("shingles").alias("sy"), "copies", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    counted = stars.join(copies.select(F.col("node").alias("centre"), "copies"), "centre")  # of numbers only
    dealt = counted.withColumn("copy", F.pmod(F.xxhash64("x"), F.col("copies")).cast("int")).drop("copies")
    return dealt.join(left, "x").join(right.drop("copies"), ["centre", "copy"]).drop("copy")


def confirmed(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The edges (x, centre) between classes whose full sets reach the similarity, as (a, b) of their smallest ids."""
    shared = F.size(F.array_intersect("sx", "sy"))
    both = beside_centres(edges.select("x", "centre"), sets).select("a", "b", shared.alias("both"), (F.size("sx") + F.size("sy")).alias("sum"))
    return both.filter(100 * F.col("both").cast("long") >= percent * (F.col("sum") - F.col("both")).cast("long")).select("a", "b")


def _alike(n: str, m: str, percent: int):
    """Sizes alone rule a link out beyond this."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def small_pairs(stars: DataFrame, percent: int) -> DataFrame:
    """(x, centre): the pairs of members of different components around a centre with few members."""
    one = stars.select("centre", "x", "n", "root")
    two = stars.select(F.col("centre").alias("c2"), F.col("x").alias("x2"), F.col("n").alias("n2"), F.col("root").alias("root2"))
    both = one.join(two, (F.col("centre") == F.col("c2")) & (F.col("x") < F.col("x2")) & (F.col("root") != F.col("root2")) & _alike("n", "n2", percent))
    return both.select("x", F.col("x2").alias("centre"))


def large_pairs(stars: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(x, centre): the pairs of members around a centre that could be links by their differences to it.

    With d = |difference to the centre|, n = |set| and r = (100 - percent) / (100 + percent), x and y are a link if their differences overlap in
    at least (v(x) + v(y)) / 2 elements, v = d - r n. For a member x outside the centre's component, v(x) + v(y) is positive for every y. With the
    least v of all possible partners in place of v(y), a member knows how many of its elements, rarest first, must hold a common one.
    """
    r = (100.0 - percent) / (100.0 + percent)
    both = beside_centres(stars.select("x", "centre", "root", "inside"), sets)
    differs = F.concat(F.array_except("sx", "sy"), F.array_except("sy", "sx"))
    members = both.select("centre", "x", "root", "inside", F.size("sx").alias("n"), differs.alias("differs"))
    members = materialise(members.withColumn("d", F.size("differs")).withColumn("v", F.col("d") - r * F.col("n")))
    least = members.groupBy(F.col("centre").alias("c")).agg(F.min(F.when(F.col("inside"), F.col("v"))).alias("v_in"), F.min(F.when(~F.col("inside"), F.col("v"))).alias("v_out"))
    elements = members.select("centre", "x", F.explode("differs").alias("element"))
    common = elements.groupBy(F.col("centre").alias("e_centre"), F.col("element").alias("e_element")).agg(F.count("*").alias("times")).filter("times > 1")
    elements = elements.join(common, (F.col("centre") == F.col("e_centre")) & (F.col("element") == F.col("e_element"))).select("centre", "x", "element", "times")
    own = Window.partitionBy("centre", "x")
    place = F.row_number().over(own.orderBy("times", "element")) - F.count("*").over(own)  # 0 is the last element
    placed = elements.withColumn("place", place).select(F.col("centre").alias("p_centre"), F.col("x").alias("p_x"), "element", "place")
    facts = members.select("centre", "x", "root", "inside", "n", "d", "v").join(least, F.col("centre") == F.col("c")).drop("c")
    placed = placed.join(facts, (F.col("p_centre") == F.col("centre")) & (F.col("p_x") == F.col("x"))).drop("p_centre", "p_x")
    prefix = lambda v: F.col("d") + F.col("place") <= F.col("d") - F.ceil((F.col("v") + F.col(v)) / 2 - 1e-6) + 1
    outer = placed.filter(~F.col("inside"))
    kept = materialise(
        outer.filter(prefix("v_out")).withColumn("side", F.lit(0))
        .unionByName(outer.filter(prefix("v_in")).withColumn("side", F.lit(1)))
        .unionByName(placed.filter("inside").filter(prefix("v_out")).withColumn("side", F.lit(2)))
        .select("centre", "element", "x", "root", "n", "v", "place", "side")
    )
    two = kept.select(*[F.col(c).alias(f"{c}_2") for c in kept.columns])
    left = F.least(-F.col("place"), -F.col("place_2")) + 1  # elements that both still have, this one included
    same = (F.col("centre") == F.col("centre_2")) & (F.col("element") == F.col("element_2")) & (F.col("root") != F.col("root_2"))
    sides = ((F.col("side") == 0) & (F.col("side_2") == 0) & (F.col("x") < F.col("x_2"))) | ((F.col("side") == 1) & (F.col("side_2") == 2))
    enough = left >= F.ceil((F.col("v") + F.col("v_2")) / 2 - 1e-6)
    met = kept.join(two, same & sides & _alike("n", "n_2", percent) & enough)
    return met.select(F.least("x", "x_2").alias("x"), F.greatest("x", "x_2").alias("centre"))


def groups(docs: DataFrame, k: int = K, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id): one row per input row."""
    ship(docs.sparkSession)
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = materialise(own.mapInArrow(_per_set(k, _signed), "doc_id long, n long, node long, bands array<long>"))
    classes = signed.filter("n > 0 and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    members = classes.select("node", "rep", "n", F.explode("bands").alias("bucket"))
    counts = members.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1").withColumnRenamed("bucket", "c_bucket")
    shared = materialise(members.join(counts, F.col("bucket") == F.col("c_bucket")).select("bucket", "node", "rep", "n", "size"))
    weight = shared.groupBy("node", "rep").agg(F.sum("size").alias("weight"))
    held = weight.select(F.col("node").alias("h_node"), F.col("rep").alias("h_rep"))
    sets = own.join(held, F.col("doc_id") == F.col("h_rep"), "left_semi").mapInArrow(_per_set(k, _full), "doc_id long, node long, shingles array<long>")
    sets = materialise(sets.join(held, (F.col("doc_id") == F.col("h_rep")) & (F.col("node") == F.col("h_node"))).select("node", F.col("doc_id").alias("rep"), "shingles").dropDuplicates(["node"]))

    shared = shared.join(weight.select(F.col("node").alias("w_node"), "weight"), F.col("node") == F.col("w_node"))
    strongest = F.max(F.struct("weight", (-F.col("rep")).alias("less"), "node", "n"))
    shared = materialise(shared.select("bucket", "node", "rep", "n", "weight"))
    centre = shared.groupBy(F.col("bucket").alias("c_bucket")).agg(strongest.alias("c")).select("c_bucket", F.col("c.node").alias("centre"), F.col("c.n").alias("cn"), (-F.col("c.less")).alias("c_rep"))
    stars = shared.join(centre, F.col("bucket") == F.col("c_bucket")).filter(F.col("node") != F.col("centre"))
    stars = materialise(stars.select(F.col("node").alias("x"), "rep", "n", "centre", "cn", "c_rep").distinct())
    links = materialise(confirmed(stars.filter(_alike("n", "cn", percent)), sets, percent))
    roots = materialise(components(links))

    # what the stars leave open
    root_of = lambda rep, name: roots.select(F.col("id").alias(rep), F.col("root").alias(name))
    placed = stars.join(root_of("rep", "r"), "rep", "left").join(root_of("c_rep", "c_root"), "c_rep", "left").select("x", "n", "centre", F.coalesce("r", "rep").alias("root"), F.coalesce("c_root", "c_rep").alias("c_root"))
    placed = materialise(placed.withColumn("inside", F.col("root") == F.col("c_root")).drop("c_root"))
    open_ = placed.groupBy(F.col("centre").alias("o_centre")).agg(F.count("*").alias("members"), F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").drop("lo", "hi")
    rest = materialise(placed.join(open_, F.col("centre") == F.col("o_centre")).drop("o_centre"))
    pairs = small_pairs(rest.filter(F.col("members") <= SMALL_STAR), percent).unionByName(large_pairs(rest.filter(F.col("members") > SMALL_STAR), sets, percent)).distinct()
    found = materialise(confirmed(materialise(pairs), sets, percent))
    if not found.isEmpty():
        roots = materialise(components(links.unionByName(found)))

    named = classes.select(F.col("node").alias("k_node"), F.col("rep")).join(roots, F.col("rep") == F.col("id"), "left").select("k_node", F.coalesce("root", "rep").alias("root"))
    out = signed.select("doc_id", "n", "node").join(named, F.col("node") == F.col("k_node"), "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("root"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.cast("long").alias("component_id"))


def dropped(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """(doc_id): the documents that are not the smallest of their group."""
    return groups(docs, k, percent).filter("doc_id <> component_id").select("doc_id").distinct()


def deduplicated(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: one document of each group stays. Rows with the same id stay together."""
    gone = dropped(docs, k, percent).withColumnRenamed("doc_id", "_gone")
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")


ORACLE_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0) x),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (WITH RECURSIVE t(id, root) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.b, t.root FROM t JOIN e ON e.a = t.id) SELECT id, min(root) AS root FROM t GROUP BY id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, r.root AS component_id, d.doc_id = r.root AS kept FROM d LEFT JOIN n USING (doc_id) JOIN r ON r.id = d.doc_id
"""
