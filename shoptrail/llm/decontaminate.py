"""Benchmark decontamination: a prefix-filtered join of item windows and documents with exact verification.

A window is ``WINDOW`` consecutive words of a benchmark item (all its words, if fewer). Seen as a set of word shingles, a
window occurs in a document only if all its shingles do, so its necessary prefix is one shingle: the rarest in the
documents. Documents report where any benchmark shingle stands (found through a bitmap of fixed size, so what is sent to
the tasks does not grow with the benchmark); those reports give the shingles' frequencies over all documents and are the
rows that join the windows' prefixes. Bounds on position and length come before the words themselves are compared.

Texts without words, null texts and items without words have no windows. Items with equal ids are one item; windows of
items with a null id count as hits but not as items. Rows of documents with equal ids stay separate rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptrail.llm import scan
from shoptrail.llm.columns import all_of
from shoptrail.runtime import stored

WINDOW = 10
#: Words of a shingle; a window of fewer words is one shingle.
SHINGLE = 5
#: Size of the bitmap of benchmark shingles: 2^24 bits are 2 MB, whatever the benchmark's size.
BITMAP_BITS = 24

_HITS = pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int32())]))
_REGIONS = pa.list_(pa.struct([("first", pa.int32()), ("words", pa.string()), ("hits", _HITS)]))


def _texts(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk: first row, lower-cased bytes, word starts and ends, word hashes, and where each text's words begin."""
    for first, data, off in scan.chunks(column):
        data = scan.LOWER[data]
        starts, ends, owner = scan.words(data, off, scan.ALNUM)
        yield first, data, starts, ends, scan.word_hashes(data, starts, ends), scan.first_of_runs(owner, len(off) - 1)


def windows(items: DataFrame, id: str = "item_id", text: str = "text", window: int = WINDOW, shingle: int = SHINGLE):
    """One row per window of every item: ``item``, ``n`` words, ``words`` joined by spaces, and its shingle ``hashes``."""

    def run(batches):
        for batch in batches:
            out = []
            ids = batch.column(0)
            for first, data, starts, ends, hashes, bounds in _texts(batch.column(1)):
                for k in range(len(bounds) - 1):
                    a, b = bounds[k], bounds[k + 1]
                    if a == b:
                        continue
                    own = [bytes(data[x:y]).decode() for x, y in zip(starts[a:b], ends[a:b])]
                    n = min(window, b - a)
                    size = min(shingle, n)
                    whole = scan.shingle_hashes(hashes[a:b], size).view(np.int64)
                    for at in range(b - a - n + 1):
                        out.append((ids[first + k].as_py(), n, " ".join(own[at : at + n]), size, whole[at : at + n - size + 1].tolist()))
            columns = list(zip(*out)) or [[]] * 5
            types = (batch.schema.field(0).type, pa.int32(), pa.string(), pa.int32(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=["item", "n", "words", "size", "hashes"])

    kind = items.schema[id].dataType.simpleString()
    return items.select(id, text).mapInArrow(run, f"item {kind}, n int, words string, size int, hashes array<bigint>").distinct()


def _bitmap(shingles: DataFrame, bits: int) -> bytes:
    """Bitmap of the low ``bits`` bits of all shingle hashes; at most 2^bits / 64 short rows reach the driver."""
    low = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1))
    words = (
        shingles.select(low.alias("low"))
        .select(F.shiftright("low", 6).alias("word"), F.expr("shiftleft(1L, cast(low & 63 as int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
    )
    bitmap = np.zeros(1 << (bits - 6), np.int64)
    rows = words.toArrow()
    bitmap[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return bitmap.tobytes()


def _reports(docs: DataFrame, rest: list[str], text: str, bitmap, sizes: list[int], reach: int, bits: int) -> DataFrame:
    """Per document: ``n_words`` and the regions around possible benchmark shingles, ``reach`` words to either side."""

    def run(batches):
        bitset = np.frombuffer(bitmap.value, np.uint8)
        for batch in batches:
            n_words = np.zeros(batch.num_rows, np.int64)
            regions: list = [None] * batch.num_rows
            for first, data, starts, ends, hashes, bounds in _texts(batch.column(len(rest))):
                n_words[first : first + len(bounds) - 1] = np.diff(bounds)
                at, found = [], []
                for size in sizes:
                    whole = scan.shingle_hashes(hashes, size)
                    low = whole & np.uint64((1 << bits) - 1)
                    hit = np.flatnonzero(bitset[(low >> np.uint64(3)).astype(np.int64)] >> (low & np.uint64(7)).astype(np.uint8) & 1)
                    hit = hit[np.searchsorted(bounds, hit, "right") == np.searchsorted(bounds, hit + size - 1, "right")]
                    at.append(hit)
                    found.append(whole[hit].view(np.int64))
                at, found = np.concatenate(at), np.concatenate(found)
                order = np.argsort(at, kind="stable")
                at, found = at[order], found[order]
                owner = np.searchsorted(bounds, at, "right") - 1
                low_end = np.maximum(at - reach, bounds[owner])
                high_end = np.minimum(at + reach + SHINGLE, bounds[owner + 1])
                new = np.ones(len(at), bool)
                new[1:] = (owner[1:] != owner[:-1]) | (low_end[1:] > high_end[:-1])
                cuts = np.append(np.flatnonzero(new), len(at))
                for a, b in zip(cuts[:-1], cuts[1:]):
                    doc, begin, end = owner[a], low_end[a], high_end[b - 1]
                    text_words = " ".join(bytes(data[x:y]).decode() for x, y in zip(starts[begin:end], ends[begin:end]))
                    hits = [{"hash": h, "at": p} for h, p in zip(found[a:b].tolist(), (at[a:b] - bounds[doc]).tolist())]
                    row = first + int(doc)
                    regions[row] = (regions[row] or []) + [{"first": int(begin - bounds[doc]), "words": text_words, "hits": hits}]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(rest)], pa.array(n_words), pa.array(regions, _REGIONS)], names=[*rest, "n_words", "regions"]
            )

    schema = docs.select(*rest).schema.add("n_words", "long")
    schema = schema.add("regions", T.DataType.fromDDL("array<struct<first:int,words:string,hits:array<struct<hash:bigint,at:int>>>>"))
    return docs.select(*rest, text).mapInArrow(run, schema)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    bitmap_bits: int = BITMAP_BITS,
) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_hit, item_ids (as sorted strings), and ``row_id``, unique in this result."""
    spark = docs.sparkSession
    parts = stored(windows(items, item_id, item_text, window), "benchmark windows")
    shingles = parts.select("size", F.explode("hashes").alias("hash")).distinct()
    sizes = sorted(r[0] for r in parts.select("size").distinct().collect())  # at most SHINGLE numbers
    bitmap = spark.sparkContext.broadcast(_bitmap(shingles, bitmap_bits))
    named = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    reports = _reports(named, ["id"], "text", bitmap, sizes or [SHINGLE], window - 1, bitmap_bits)
    reports = stored(reports.withColumn("row_id", F.monotonically_increasing_id()), "reports")
    regions = reports.select("row_id", "n_words", F.inline("regions"))
    frequency = regions.select(F.inline("hits")).groupBy("hash").agg(F.count("*").alias("df"))
    # The prefix of a window: its rarest shingle, with its place in the window. No report at all: it occurs nowhere.
    # Windows have numbers from here on, so that one which many items share is one row and its hits carry no item.
    prefix = (
        parts.select("n", "words", "hashes")
        .distinct()
        .select("n", "words", F.posexplode("hashes").alias("offset", "hash"))
        .join(frequency, "hash", "left")
        .groupBy("n", "words")
        .agg(F.min_by(F.struct("hash", "offset", "df"), F.struct(F.coalesce("df", F.lit(0)), "hash", "offset")).alias("p"))
        .where("p.df is not null")
        .select("p.hash", "p.offset", "n", "words", F.monotonically_increasing_id().alias("window_no"))
    )
    prefix = stored(prefix, "prefixes")
    hits = regions.select("row_id", "n_words", "first", "words", F.inline("hits"))
    start = F.col("at") - F.col("offset")
    found = (
        hits.join(prefix.withColumnRenamed("words", "window"), "hash")
        .where((start >= 0) & (start + F.col("n") <= F.col("n_words")))
        .where(F.expr("array_join(slice(split(words, ' '), at - offset - first + 1, n), ' ') = window"))
        .select("row_id", start.alias("begin"), (start + F.col("n")).alias("end"), "window_no")
    )
    found = stored(found, "hits")
    spans = found.groupBy("row_id").agg(F.array_sort(F.collect_set(F.struct("begin", "end"))).alias("spans"))
    # Items of the windows that occur, found once per row and window.
    occurring = prefix.join(found.select("window_no").distinct(), "window_no", "left_semi").select("window_no", "n", "words")
    items_of = parts.select(F.col("item").cast("string").alias("item"), "n", "words").where("item is not null")
    items_of = items_of.join(occurring, ["n", "words"]).select("window_no", "item").distinct()
    named_items = (
        found.select("row_id", "window_no")
        .distinct()
        .join(items_of, "window_no")
        .groupBy("row_id")
        .agg(F.array_sort(F.collect_set("item")).alias("item_ids"))
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto")),
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["begin"], s["upto"]))).alias("n"),
            F.greatest(s["upto"], x["end"]).alias("upto"),
        ),
        lambda s: s["n"],
    )
    spans = spans.select("row_id", covered.alias("n_hit"))
    counted = reports.select("id", "row_id", "n_words").join(spans, "row_id", "left").join(named_items, "row_id", "left")
    return counted.select(
        F.col("id").alias(id),
        "row_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def query(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = contamination(documents, benchmark)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a window of an item.

    Rows are known by two hashes of their text, as equal texts are equally contaminated; so no copy of the documents is
    numbered and stored, and the few contaminated texts are what joins.
    """
    key = F.struct(F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"))
    found = contamination(docs.select(key.alias("key"), "text"), items, id="key")
    dirty = stored(found.where("n_hit > 0").select("key.k1", "key.k2").distinct(), "contaminated texts")
    same = (key["k1"] == dirty["k1"]) & (key["k2"] == dirty["k2"])
    return docs.join(dirty, same, "left_anti").select(*all_of(docs))


#: DuckDB counterpart of ``query``.
SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, n, list_aggregate(w[i : i + n - 1], 'string_agg', ' ') AS s
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, list_aggregate(w[i : i + n - 1], 'string_agg', ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)),
m AS (SELECT doc_id, item_id, i, bw.n FROM dw JOIN bw ON dw.n = bw.n AND dw.s = bw.s),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS xs
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM m WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(xs, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
