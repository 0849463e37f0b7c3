"""Removal of boilerplate lines that spread over many sites.

Every line hash gets a HyperLogLog sketch of its sites; sketches merge by aggregation, so a line that all documents share
costs one small sketch per task. Lines whose estimate is near the threshold get exact distinct counts. A line on at least
``SITES`` sites stays where it first occurs (smallest document id, nulls last) and is removed everywhere else, so its words
stay once in the corpus. Rows of documents are never removed; a document may become empty.

With ``long_words``, lines of so many words or more are removed from ``LONG_SITES`` sites on: long passages do not repeat across
sites by chance. The pipeline's stage does so; the query keeps the one threshold of its SQL.

Lines end at line feeds and are compared without leading and trailing spaces; shorter ones than ``MIN_CHARS`` are too common
by chance and always stay. A null site is a site of its own. Null texts stay null. Rows that repeat id and text are treated
alike: each keeps a line that first occurs in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.columns import all_of, quoted, unused
from shoptrail.llm.mixing import word_count
from shoptrail.runtime import stored

#: Distinct sites from which a line is boilerplate.
SITES = 6
#: Words from which a line is a long passage in the pipeline, and the distinct sites from which such a line is boilerplate.
LONG_WORDS, LONG_SITES = 50, 2
MIN_CHARS = 20
#: Sketches have 2^LG_K cells: a standard error of 1.04 / 2^(LG_K / 2).
LG_K = 10
#: Estimates within so many standard errors of the threshold, or within one, are counted exactly.
ERRORS = 5


def _lines(docs: DataFrame, id: str, text: str, site: str, min_chars: int, long_words: int | None = None) -> DataFrame:
    line = F.trim("line")
    # A line of so many words has at least twice as many characters, less one.
    is_long = F.lit(False) if long_words is None else (F.length(line) >= 2 * long_words - 1) & (word_count(line) >= long_words)
    lines = docs.select(
        F.col(id).alias("id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"),
        F.coalesce(F.concat(F.lit("="), F.col(site).cast("string")), F.lit("")).alias("site"),
        F.posexplode(F.split(text, "\n")).alias("at", "line"),
    )
    lines = lines.where(F.length(line) >= min_chars)
    hashes = [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2")]
    return lines.select("id", "t1", "t2", "site", "at", *hashes, is_long.alias("long"))


def boilerplate(lines: DataFrame, sites: int = SITES, lg_k: int = LG_K, long_sites: int = LONG_SITES) -> DataFrame:
    """``(h1, h2, first)`` of the lines on at least ``sites`` sites (``long`` ones: ``long_sites``); ``first`` is their first occurrence."""
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "t1", "t2", "at")
    sketched = lines.groupBy("h1", "h2").agg(
        F.hll_sketch_agg("site", lg_k).alias("sketch"), F.min(place).alias("first"), F.max("long").alias("long"),
        (F.min("site") != F.max("site")).alias("spread"),
    )
    need = F.when(F.col("long"), long_sites).otherwise(sites)
    sketched = sketched.select("h1", "h2", "first", "spread", need.alias("need"), F.hll_sketch_estimate("sketch").alias("estimate"))
    band = F.greatest(F.lit(1.0), F.lit(ERRORS * 1.04 / 2 ** (lg_k / 2)) * F.col("need"))
    # Most lines stand on one site, which is known without an estimate.
    candidates = (F.col("spread") | (F.col("need") < 2)) & (F.col("estimate") >= F.col("need") - band)
    sketched = stored(sketched.where(candidates).drop("spread"), "line sketches")
    near = sketched.where(F.col("estimate") <= F.col("need") + band)
    exact = lines.join(near.select("h1", "h2"), ["h1", "h2"], "left_semi").select("h1", "h2", "site").distinct()
    exact = exact.groupBy("h1", "h2").agg(F.count("*").alias("n"))
    sure = sketched.where(F.col("estimate") > F.col("need") + band).select("h1", "h2", "first")
    return sure.union(near.join(exact, ["h1", "h2"]).where("n >= need").select("h1", "h2", "first"))


def cleaned(
    docs: DataFrame, id: str = "doc_id", text: str = "text", site: str = "source", sites: int = SITES, min_chars: int = MIN_CHARS,
    long_words: int | None = None,
) -> DataFrame:
    """All rows and columns of ``docs`` with the text cleaned, and a last column: the numbers of lines, and of the removed ones.

    The last column is named ``lines`` or, where ``docs`` has such a column, like it.
    """
    names = ["same_id", "same_t1", "same_t2", "dropped", "k1", "k2"]
    o_id, t1, t2, dropped, k1, k2 = (unused(docs, name) for name in names)
    lines = stored(_lines(docs, id, text, site, min_chars, long_words), "lines")
    common = stored(boilerplate(lines, sites), "boilerplate")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "t1", "t2", "at")
    drops = lines.join(common, ["h1", "h2"]).where(place != F.col("first"))
    drops = drops.groupBy(F.col("id").alias(o_id), F.col("t1").alias(t1), F.col("t2").alias(t2))
    drops = stored(drops.agg(F.collect_set("at").alias(dropped)), "removed lines")
    keyed = docs.withColumns({k1: F.xxhash64(text), k2: F.xxhash64(F.lit(1), text)})
    same = (quoted(k1) == quoted(t1)) & (quoted(k2) == quoted(t2)) & F.col(id).eqNullSafe(quoted(o_id))
    joined = keyed.join(drops, same, "left")
    parts = F.split(text, "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), quoted(dropped))
    clean = F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n")
    counts = F.struct(F.size(parts).alias("n"), F.coalesce(F.size(quoted(dropped)), F.lit(0)).alias("removed"))
    lines = counts.alias(unused(docs, "lines"))
    whole = F.when(quoted(dropped).isNull(), F.col(text)).otherwise(clean)
    return joined.select(*[whole.alias(c) if c == text else quoted(c) for c in docs.columns], lines)


def query(documents: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, and size and digest of the cleaned text, of every document (null text: 0, null)."""
    return cleaned(documents.select("doc_id", "text", "source")).select(
        "doc_id",
        F.greatest(F.col("lines.n"), F.lit(0)).cast("long").alias("n_lines"),
        F.col("lines.removed").cast("long").alias("n_removed"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.sha2("text", 256).alias("text_sha256"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    return cleaned(docs, long_words=LONG_WORDS).select(*all_of(docs))


#: DuckDB counterpart of ``query``.
SQL = """
WITH l AS (
  SELECT doc_id, source, generate_subscripts(s, 1) - 1 AS pos, trim(unnest(s), ' ') AS line
  FROM (SELECT doc_id, source, string_split(text, chr(10)) AS s FROM documents WHERE text IS NOT NULL)),
b AS (
  SELECT line, min((doc_id, pos)) AS f FROM l WHERE length(line) >= 20
  GROUP BY line HAVING count(DISTINCT coalesce('=' || source, '')) >= 6),
x AS (SELECT doc_id, list(pos) AS gone FROM l JOIN b USING (line) WHERE (doc_id, pos) <> f GROUP BY doc_id),
r AS (
  SELECT d.doc_id, string_split(text, chr(10)) AS s, coalesce(gone, []) AS gone FROM documents d LEFT JOIN x USING (doc_id)),
c AS (
  SELECT doc_id, s, gone, CASE WHEN len(gone) = 0 THEN array_to_string(s, chr(10)) ELSE coalesce(array_to_string(
    list_transform(list_filter(range(1, len(s) + 1), lambda i: NOT list_contains(gone, i - 1)), lambda i: s[i]), chr(10)), '') END AS t
  FROM r)
SELECT doc_id, coalesce(len(s), 0)::BIGINT AS n_lines, len(gone)::BIGINT AS n_removed, coalesce(strlen(t), 0)::BIGINT AS n_bytes,
  sha256(t) AS text_sha256 FROM c
"""
