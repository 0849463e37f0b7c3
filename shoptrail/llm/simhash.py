"""SimHash near-duplicate detection with multi-index hashing.

Fingerprints of 64 bits link when they differ in at most 4 bits. A pair within the distance differs in at most 2 bits in one
of its two halves of 32 bits, so some value lies within 1 bit of both halves there. Every distinct fingerprint is stored in
the tables of both halves under the small Hamming balls of radius 1 around its own values and meets the others there;
complete distances are then verified. Values of 32 bits are long enough that chance fills no bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.llm import scan
from shoptrail.llm.columns import all_of, quoted, unused
from shoptrail.llm.components import components
from shoptrail.runtime import stored

SHINGLE_WORDS = 4
SEED = 42


def _fingerprints_of(column: pa.Array, shingle: int, seed: int) -> np.ndarray:
    out = np.zeros(len(column), np.uint64)
    for first, data, off in scan.chunks(column):
        data = scan.LOWER[data]
        starts, ends, owner = scan.words(data, off, scan.NOT_BLANK)
        if not len(starts):
            continue
        # One space after each word: every shingle is then one contiguous range.
        lengths = ends - starts
        new_start = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        text = np.full(int(lengths.sum() + len(lengths)), 0x20, np.uint8)
        inside = scan.NOT_BLANK[data]
        text_inside = np.ones(len(text), bool)
        text_inside[new_start + lengths] = False
        text[text_inside] = data[inside]
        new_end = new_start + lengths
        bounds = scan.first_of_runs(owner, len(off) - 1)
        n_words = np.diff(bounds)
        n_shingles = np.where(n_words >= shingle, n_words - shingle + 1, np.minimum(n_words, 1))
        of_text = np.repeat(np.arange(len(n_words)), n_shingles)
        begins = np.concatenate([[0], np.cumsum(n_shingles)[:-1]])
        first_word = np.arange(len(of_text)) - begins[of_text] + bounds[of_text]
        last_word = np.minimum(first_word + shingle, bounds[of_text + 1]) - 1
        raw = memoryview(text)
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter(
            (digest(raw[a:b], seed) for a, b in zip(new_start[first_word].tolist(), new_end[last_word].tolist())),
            np.uint64,
            len(of_text),
        )
        has = np.flatnonzero(n_shingles)
        for part in np.array_split(has, max(1, len(has) // 64)):
            a, b = begins[part[0]], begins[part[-1]] + n_shingles[part[-1]]
            bits = np.unpackbits(hashes[a:b].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            ones = np.add.reduceat(bits, begins[part] - a, axis=0, dtype=np.int64)
            packed = np.packbits(2 * ones > n_shingles[part][:, None], axis=1)
            out[first + part] = packed.view(">u8").ravel()
    return out


def fingerprints(
    docs: DataFrame,
    text: str = "text",
    shingle: int = SHINGLE_WORDS,
    seed: int = SEED,
    fingerprint: str = "fp",
    keep_text: bool = False,
) -> DataFrame:
    """All columns of ``docs`` (without the text, unless it is kept) and the fingerprint as a long.

    A-Z is lower-cased; words are runs of bytes other than space and 0x09-0x0D. A text of fewer words than a shingle is
    one shingle; null, empty and blank texts have fingerprint 0.
    """
    names = [c for c in docs.columns if c != text] + [text]
    rows = docs.select(*[quoted(c) for c in names])
    out = names if keep_text else names[:-1]

    def run(batches):
        for batch in batches:
            fp = _fingerprints_of(batch.column(len(names) - 1), shingle, seed).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(out)], pa.array(fp)], names=[*out, fingerprint])

    return rows.mapInArrow(run, rows.select(*[quoted(c) for c in out]).schema.add(fingerprint, "long"))


#: (lowest bit, bits) of each segment. Two balls of radius 1 cover distances up to 2 in one of two segments, so up to 4 + 1 in all.
SEGMENTS = ((0, 32), (32, 32))
DISTANCE = 4


def _keys(fp):
    """The values within 1 bit of each segment, numbered by segment."""
    rows = []
    for number, (low, bits) in enumerate(SEGMENTS):
        value = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << bits) - 1))
        rows += [value.bitwiseXOR(F.lit(mask)) + F.lit(number << 32) for mask in [0, *(1 << k for k in range(bits))]]
    return F.array(*rows)


def _flip(fp: str, key: str):
    """The bit that the key of a bucket has flipped in the fingerprint's segment; 0 for the segment's own value."""
    halves = [F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << bits) - 1)) for low, bits in SEGMENTS]
    value = F.when(F.col(key) < (1 << 32), halves[0]).otherwise(halves[1])
    return value.bitwiseXOR(F.col(key)).bitwiseAND(F.lit((1 << 32) - 1))


def _near(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= DISTANCE


#: Fingerprints of a bucket beyond which they are linked through common midpoints: a group of near copies, whose pairs are
#: not listed. Both ways are exact. A member of a bucket has 33 or 529 midpoints, so beyond this size pairs would be more.
HOT_BUCKET = 128


def _masks(most: int):
    """Masks of up to ``most`` (1 or 2) bits of a segment."""
    ones = [1 << k for k in range(32)]
    return F.lit([0, *ones, *(a | b for a in ones for b in ones if a < b and most == 2)]).cast("array<bigint>")


def _stars(rows: DataFrame) -> DataFrame:
    """Links among the rows ``(fp, key, pivot)`` of each bucket: with its pivot and by common midpoints.

    Two fingerprints differ in at most 4 bits just if some point lies within 2 of both; those that meet in a bucket have one with
    the bucket's value in its segment, of which they are 1 bit away already if they have a flip there. Each fingerprint
    meets one other around each such point, so a bucket of n gives at most 529 n rows, not n^2. Links between two that
    link with the pivot, one of the bucket, are left out: mostly that leaves n.
    """
    halves = [F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << bits) - 1)) for low, bits in SEGMENTS]
    other = F.when(F.col("key") < (1 << 32), halves[1]).otherwise(halves[0])
    around = F.when(_flip("fp", "key") == 0, _masks(2)).otherwise(_masks(1))
    rows = rows.withColumn("far", ~_near("fp", "pivot"))
    points = rows.select("fp", "far", "key", F.explode(F.transform(around, lambda m: other.bitwiseXOR(m))).alias("point"))
    met = points.groupBy("key", "point").agg(F.min(F.struct("far", "fp")).alias("one"))
    met = points.where("far").join(met, ["key", "point"]).select(F.col("fp").alias("fp_a"), F.col("one.fp").alias("fp_b"))
    with_pivot = rows.where("not far").select(F.col("fp").alias("fp_a"), F.col("pivot").alias("fp_b"))
    return met.union(with_pivot).where("fp_a <> fp_b").distinct()


def links(prints: DataFrame, fp: str = "fp", hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """Pairs ``(fp_a, fp_b)`` of the distinct fingerprints ``fp`` that differ in 1 to 4 bits.

    Every such pair is a row or, where its segment key holds more than ``hot_bucket`` fingerprints, connected by rows.
    Fingerprints with equal segments share all of its keys and meet under their own value alone, so a bucket where all
    have the same flip holds no pair.
    """
    table = stored(prints.select(F.col(fp).alias("fp"), F.explode(_keys(F.col(fp))).alias("key")), "segment tables")
    hot = table.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_bucket).select("key")
    hot = stored(hot, "hot-buckets")
    # Both sides alike, so that they are shuffled once.
    cool = table.join(hot, "key", "left_anti")
    x, y = cool.alias("x"), cool.alias("y")
    meet = (_flip("x.fp", "x.key") != _flip("y.fp", "y.key")) | (_flip("x.fp", "x.key") == 0)
    found = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.fp") < F.col("y.fp")) & _near("x.fp", "y.fp") & meet)
    crowded = stored(table.join(hot, "key", "left_semi"), "crowded buckets")
    flip = _flip("fp", "key")
    buckets = crowded.groupBy("key").agg(F.min("fp").alias("pivot"), F.min(flip).alias("low"), F.max(flip).alias("high"))
    buckets = stored(buckets.where("low < high or high = 0").select("key", "pivot"), "pivots")
    return found.select(F.col("x.fp").alias("fp_a"), F.col("y.fp").alias("fp_b")).union(_stars(crowded.join(buckets, "key")))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``fp`` (long), ``row_id`` and ``component_id``: the smallest id that is reachable.

    Links are those of ``links`` and equal fingerprints; documents without words share fingerprint 0 and link like any
    other. Rows with equal ids stay separate rows; null ids take part but are never the smallest (a component of null
    ids only has a null component_id). Exact copies meet in one fingerprint before anything is compared.
    """
    prints = fingerprints(docs.select(id, text), text)
    prints = stored(prints.withColumn("row_id", F.monotonically_increasing_id()), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min(id).alias("least_id")), "fingerprints")
    roots = components(links(distinct), "fp_a", "fp_b")
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = stored(rooted.join(least, "root").select("fp", "component_id", "root"), "classes")
    return prints.join(classes, "fp").select(id, "row_id", "fp", "component_id", "root")


def deduplicated(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id (nulls last; of repeated ids, the first row)."""
    row, fp = unused(docs, "row"), unused(docs, "fingerprint")
    kept = fingerprints(docs.withColumn(row, F.monotonically_increasing_id()), text, fingerprint=fp, keep_text=True)
    kept = stored(kept, "fingerprints")
    order = F.struct(quoted(id).isNull(), quoted(id), quoted(row))
    prints = kept.groupBy(quoted(fp).alias("fp")).agg(F.min_by(quoted(row), order).alias("row"), F.min(order).alias("order"))
    prints = stored(prints, "distinct fingerprints")
    roots = components(links(prints), "fp_a", "fp_b")
    rooted = prints.join(roots, prints.fp == roots.node, "left").select("row", "order", F.coalesce("root", "fp").alias("root"))
    stay = stored(rooted.groupBy("root").agg(F.min_by("row", "order").alias(row)).select(row), "kept rows")
    # The rows that stay grow with the documents: the same join at every size, never a broadcast.
    return kept.join(stay.hint("merge"), row, "left_semi").select(*all_of(docs))


def query(documents: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every document."""
    found = near_duplicates(documents.select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
