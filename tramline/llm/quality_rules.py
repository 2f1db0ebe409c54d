"""Quality rules: Gopher-like base rules and cross-document line frequency per host.

Every document's lines are normalised (lower case, blanks collapsed) and hashed. For each (host, line) the operator counts
distinct documents, removes the lines above the limit and rejects documents that this leaves depleted. DataFrame
functions only.

Counting documents, not copies. A document is represented by the hash of its normalised lines. Exact copies therefore count
once however many there are, so a copied clean document is never mistaken for boilerplate, and different documents never
collapse. Lines of any length are counted.

Defined results: null or empty text has no words and fails the base rules; a null host is a host of its own; repeated rows
get equal results, each in its own row, and count once; a line that occurs more than once in a document counts once but is removed everywhere
in it; a line at the limit exactly stays; texts of any length are read whole (a line's words and hash in one pass); an empty table
gives an empty result; extra input columns never clash, as only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import let, materialise, words_of

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_DOCS_PER_LINE = 20
MIN_LEFT_PERCENT = 50


def window_hashes(words: Column) -> Column:
    """Hashes of the consecutive 8-word windows; none where a window can't repeat."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    windows = let(hashes, lambda h: F.transform(F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(h, i, WINDOW))))
    return F.when(F.size(words) > WINDOW, windows).otherwise(F.array().cast("array<bigint>"))


def _twice(windows: Column) -> Column:
    """Sorted positions of the windows that occur more than once."""
    by_hash = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
    found = let(by_hash, lambda b: F.filter(F.transform(b, lambda x, k: F.when(same(x, F.get(b, k - 1)) | same(x, F.get(b, k + 1)), x["i"])), lambda i: i.isNotNull()))
    return F.sort_array(found)


def repeated_words(words: Column) -> Column:
    """Number of words inside 8-word windows that occur twice or more in the same text, the first occurrence included.

    The sort runs only for texts that do repeat a window.
    """

    def count(windows: Column) -> Column:
        covered = F.aggregate(
            _twice(windows),
            F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("at")),
            lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["at"])).alias("n"), i.alias("at")),
            lambda acc: acc["n"],
        )
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(covered)

    return let(window_hashes(words), count)


def analysed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """(doc_id, text_key, host, base figures, base_failed, parts array<struct<h, n>>, whole): everything that is read from a text, in one pass.

    ``parts`` are the lines with a word, as hash of the normalised line and number of words; ``whole`` is the hash of all of them.
    """
    full = F.coalesce(F.col(text), F.lit(""))
    own = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"), F.col(host).alias("host"), full.alias("full"))
    lines = F.transform(F.split("full", "\n"), lambda x: F.struct(x.alias("line"), words_of(x).alias("w")))
    own = own.withColumn("lines", F.filter(lines, lambda x: F.size(x["w"]) > 0))
    own = own.withColumn("words", F.flatten(F.transform("lines", lambda x: x["w"])))
    whole_lines = F.transform("lines", lambda x: x["line"])
    parts = F.transform("lines", lambda x: F.struct(words_hash(x["w"]).alias("h"), F.size(x["w"]).alias("n")))
    own = own.select(
        "doc_id", "text_key", "host", F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("full", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"), (F.size("lines") - F.size(F.array_distinct(whole_lines))).cast("long").alias("n_dup_lines"),
        let(F.col("words"), repeated_words).cast("long").alias("n_repeat_words"), parts.alias("parts"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return own.withColumns({"base_failed": failed, "whole": F.xxhash64(F.transform("parts", lambda x: x["h"]))})


def words_hash(words: Column) -> Column:
    """Hash of a normalised line: its words in lower case, with one blank between them."""
    return F.xxhash64(F.lower(F.array_join(words, " ")))


def frequent_lines(found: DataFrame, max_docs: int = MAX_DOCS_PER_LINE) -> DataFrame:
    """(host, h, n_docs) of the lines in more than ``max_docs`` documents of a host, from analysed().

    Copies combine map-side in the first aggregation, and a hot line costs one row a task in the second.
    """
    seen = found.select("host", "whole", F.explode(F.array_distinct(F.transform("parts", lambda x: x["h"]))).alias("h")).distinct()
    return seen.groupBy("host", "h").agg(F.count("*").alias("n_docs")).filter(F.col("n_docs") > max_docs)


def verdicts(found: DataFrame, max_docs: int = MAX_DOCS_PER_LINE) -> DataFrame:
    """analysed() with n_removed, removed (hashes of the document's removed lines, null if it loses none) and kept."""
    often = frequent_lines(found, max_docs).select(F.col("host").alias("o_host"), F.col("h").alias("o_h"))
    # documents with equal lines of a host lose the same lines, so each such list is looked up once
    lists = found.groupBy("host", "whole").agg(F.first("parts").alias("parts"))
    lines = lists.select("host", "whole", F.explode("parts").alias("p")).select("host", "whole", "p.h", "p.n")
    hit = lines.join(often, F.col("host").eqNullSafe(F.col("o_host")) & (F.col("h") == F.col("o_h")), "left_semi")
    gone = hit.groupBy(F.col("host").alias("g_host"), F.col("whole").alias("g_whole")).agg(F.sum("n").alias("n_removed"), F.collect_set("h").alias("removed"))
    out = found.join(materialise(gone), F.col("host").eqNullSafe(F.col("g_host")) & (F.col("whole") == F.col("g_whole")), "left")
    out = out.withColumn("n_removed", F.coalesce("n_removed", F.lit(0)).cast("long"))
    left = F.col("n_words") - F.col("n_removed")
    depleted = (F.col("n_removed") > 0) & (left < MIN_WORDS) & (100 * left < MIN_LEFT_PERCENT * F.col("n_words"))
    return out.withColumn("kept", ~F.col("base_failed") & ~depleted)


def judge(docs: DataFrame, max_docs: int = MAX_DOCS_PER_LINE, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per input row: the base figures, the words in removed lines and the verdict. No text is shuffled."""
    out = verdicts(materialise(analysed(docs, doc_id, text, host)), max_docs)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_removed", "kept")


def clean(docs: DataFrame, max_docs: int = MAX_DOCS_PER_LINE) -> DataFrame:
    """The kept documents without their removed lines, in the columns of ``docs`` (doc_id, text, lang, source, n_chars).

    Verdicts are stored by document and text, and only those that change something are looked up: which documents go, and what others lose.
    """
    out = verdicts(materialise(analysed(docs)), max_docs).filter("not kept or removed is not null")
    key = [F.col("doc_id").alias("k_id"), F.col("text_key").alias("k_text"), F.col("host").alias("k_host")]
    out = materialise(out.select(*key, "kept", "removed").groupBy("k_id", "k_text", "k_host").agg(F.first("kept").alias("kept"), F.first("removed").alias("removed")))
    on = F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.xxhash64("text") == F.col("k_text")) & F.col("source").eqNullSafe(F.col("k_host"))
    own = docs.select("doc_id", "text", "lang", "source", "n_chars").join(out, on, "left").filter(F.coalesce("kept", F.lit(True)))
    rest = F.filter(F.split("text", "\n"), lambda x: ~F.array_contains("removed", let(words_of(x), words_hash)))
    text = F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(rest, "\n"))
    n = F.when(F.col("removed").isNull(), F.col("n_chars")).otherwise(F.length(text)).cast("long")
    return own.select("doc_id", text.alias("text"), "lang", "source", n.alias("n_chars"))


ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
b AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols FROM d),
dl AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n_dup_lines FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d) x
  WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
win AS (SELECT doc_id, i, array_to_string(w[i:i+7], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) > 8) x),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) x WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM rep) x GROUP BY doc_id),
-- every line of every document; two documents are one if all their lines read alike
li AS (SELECT doc_id, source, trim(regexp_replace(lower(l), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS line, row_number() OVER () AS k FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS l FROM d) y WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]')),
own AS (SELECT doc_id, md5(string_agg(line, chr(10) ORDER BY k)) AS reads FROM li GROUP BY doc_id),
often AS (SELECT source, line FROM li JOIN own USING (doc_id) GROUP BY source, line HAVING count(DISTINCT reads) > {MAX_DOCS_PER_LINE}),
gone AS (SELECT doc_id, sum(len(regexp_extract_all(li.line, '[^ ]+'))) AS n_removed FROM li JOIN often ON often.line = li.line AND often.source IS NOT DISTINCT FROM li.source GROUP BY doc_id),
f AS (SELECT b.doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_removed, 0) AS n_removed
  FROM b LEFT JOIN dl USING (doc_id) LEFT JOIN cov USING (doc_id) LEFT JOIN gone USING (doc_id)),
g AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM f)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
 CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, CAST(n_removed AS BIGINT) AS n_removed,
 NOT base_failed AND NOT (n_removed > 0 AND n_words - n_removed < {MIN_WORDS} AND 100 * (n_words - n_removed) < {MIN_LEFT_PERCENT} * n_words) AS kept
FROM g
"""
