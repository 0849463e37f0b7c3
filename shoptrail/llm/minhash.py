"""MinHash near-duplicate detection by an inverted join of signature coordinates.

A text is the set of its three-word shingles; texts link when their sets have ``SIMILAR`` of their union in common. A
signature holds the least hash of the set under each of ``COORDINATES`` hash functions; two sets agree in a coordinate with
the probability of their similarity, so sets similar enough agree in fewer than ``MATCHES`` coordinates once in ten million.

Each distinct set is posted under its pairs of coordinate and value, and sets meet in these lists:

* *Prefixes.* Lists are ordered by length. A set with ``n`` values that another set has as well needs ``MATCHES`` of them, so
  one of its ``n - MATCHES + 1`` shortest lists must hold any partner; the long lists of common passages are skipped, and
  sets with fewer than ``MATCHES`` such values, nearly all of a corpus, are skipped altogether.
* *Merging.* Sets that meet in a list of up to ``SHORT`` count their matches, and pairs with ``MATCHES`` or more compare their
  whole sets.
* *Crowded lists.* A list of n near copies is not paired, which would take n^2 steps: each member compares with one of
  them, the pivot. The members' differences from it show the group's centre, the elements that most of them have, and how far
  each member is from there. Two sets differ just where their differences from the centre differ, so members close to it link
  with the closest one, and a member further away links only with what shares some of its differences: those are joined
  by the same prefixes, with a bound of its own for each member. Near copies that were changed in different places have hardly
  any difference in common, and few of them meet. Nothing is capped or left out.

Whole sets decide in the end; components are those of all links. Exact copies, and texts with the same set, meet in one
node before anything is posted, so their number does not matter.

A-Z is lower-cased; words are runs of bytes other than space and 0x09-0x0D; a text of one or two words is one shingle. Null
texts and texts without words have the empty set, link with nothing, and are components of their own. Rows with equal ids stay
separate rows; null ids take part but are never the smallest, and a component of null ids only has a null ``component_id``.
The memory of a task grows with its longest text. Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptrail.llm import scan
from shoptrail.llm.columns import quoted
from shoptrail.llm.components import components
from shoptrail.runtime import stored

SHINGLE_WORDS = 3
#: Texts link from this part of the union on: 85 of 100.
SIMILAR = (85, 100)
#: P(fewer than 26 of 48 agree) is below 1e-7 at similarity 0.85.
COORDINATES, MATCHES = 48, 26
#: Members up to which a list is paired.
SHORT = 8
SEED = 42
#: Shingles that are hashed at once, and rows that are handed on at once.
PIECE, SLICE = 512, 256

_draw = np.random.Generator(np.random.PCG64(SEED))
_FLIP = _draw.integers(0, 1 << 63, (COORDINATES, 1), dtype=np.uint64) * np.uint64(2)
_TIMES = _draw.integers(0, 1 << 63, (COORDINATES, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_NUMBER = np.arange(COORDINATES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_SECOND = np.uint64(0xD1B54A32D192ED03)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for _, data, off in scan.chunks(column):
        data = scan.LOWER[data]
        starts, ends, owner = scan.words(data, off, scan.NOT_BLANK)
        hashes = scan.word_hashes(data, starts, ends)
        bounds = scan.first_of_runs(owner, len(off) - 1).tolist()
        for a, b in zip(bounds[:-1], bounds[1:]):
            size = min(SHINGLE_WORDS, b - a)
            yield np.unique(scan.shingle_hashes(hashes[a:b], size)) if size else np.empty(0, np.uint64)


def _name(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    with np.errstate(over="ignore"):
        return int(scan.mix(shingles).sum(dtype=np.uint64)), int(scan.mix(shingles ^ _SECOND).sum(dtype=np.uint64))


def _signature(shingles: np.ndarray) -> np.ndarray:
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), PIECE):
            least = np.minimum(least, ((shingles[at : at + PIECE] ^ _FLIP) * _TIMES).min(axis=1))
        return scan.mix(least + _NUMBER)


def _lists(flat: np.ndarray, sizes: np.ndarray | int) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(flat.view(np.int64)))


def _scanned(docs: DataFrame, id: str, text: str, signatures: bool) -> DataFrame:
    """``id``, the set's two names ``h1`` and ``h2`` and its ``size`` for each row, and its signature or else the text."""
    rows = docs.select(quoted(id).alias("id"), quoted(text).cast("string").alias("text"))
    last = T.StructField("signature", T.ArrayType(T.LongType())) if signatures else T.StructField("text", T.StringType())
    names = [T.StructField(n, T.LongType()) for n in ("h1", "h2", "size")]

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                n = batch.num_rows
                sets = np.zeros((3, n), np.uint64)
                found = np.zeros((n, COORDINATES), np.uint64)
                for k, shingles in enumerate(shingle_sets(batch.column(1))):
                    sets[:, k] = *_name(shingles), len(shingles)
                    if signatures and len(shingles):
                        found[k] = _signature(shingles)
                end = _lists(found.ravel(), np.full(n, COORDINATES)) if signatures else batch.column(1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(s.view(np.int64)) for s in sets), end], names=["id", "h1", "h2", "size", last.name]
                )

    return rows.mapInArrow(run, T.StructType([rows.schema["id"], *names, last]))


def _met(postings: DataFrame) -> DataFrame:
    """Lists that a common key brings together: ``(node, key, length, pivot, known)`` of the prefixes of the nodes.

    ``postings`` are distinct rows ``(node, key, need)``: two nodes must have ``need`` keys in common, the larger of
    both their numbers. ``length`` is the number of members, ``pivot`` the one whose keys most nodes have (their
    number is ``known``): it changes little from list to list, and near copies are less apart from it than from each other.
    """
    common = postings.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    common = postings.join(stored(common, "common keys"), "key")
    entries = F.array_sort(F.collect_list(F.struct("n", "key")))
    nodes = common.groupBy("node", "need").agg(entries.alias("entries")).where(F.size("entries") >= F.col("need"))
    prefix = F.slice("entries", F.lit(1), (F.size("entries") - F.col("need") + 1).cast("int"))
    known = F.aggregate(F.col("entries").n, F.lit(0).cast("long"), lambda total, n: total + n)
    prefixes = stored(nodes.select("node", known.alias("known"), F.explode(prefix.key).alias("key")), "prefixes")
    first = F.max(F.struct("known", "node"))
    lists = prefixes.groupBy("key").agg(F.count(F.lit(1)).alias("length"), first.node.alias("pivot"), first.known.alias("known"))
    return stored(prefixes.drop("known").join(stored(lists.where("length > 1"), "lists"), "key"), "lists")


def _enough(common: Column, a: Column, b: Column) -> Column:
    part, whole = SIMILAR
    return whole * common >= part * (a + b - common)


def _with_matches(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` that agree in enough coordinates and may be similar enough by their sizes."""
    part, whole = SIMILAR
    one = lambda x: nodes.select(F.col("node").alias(x), F.col("size").alias(f"size_{x}"), F.col("signature").alias(f"signature_{x}"))
    both = pairs.join(one("a"), "a").join(one("b"), "b")
    agree = F.size(F.filter(F.zip_with("signature_a", "signature_b", lambda x, y: x == y), lambda same: same))
    sizes = whole * F.least("size_a", "size_b") >= part * F.greatest("size_a", "size_b")
    return both.where(sizes & (agree >= MATCHES)).select("a", "b")


def _whole_sets(docs: DataFrame, id: str, text: str, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(node, shingles)`` of the nodes in ``wanted``: one text of each is read again."""
    reps = nodes.join(wanted, "node", "left_semi").select("node", "h1", "h2", "rep")
    texts = _scanned(docs, id, text, signatures=False).select("h1", "h2", F.xxhash64("id").alias("rep"), "text")
    # Copies under one id are still several rows.
    texts = stored(texts.join(stored(reps, "wanted").hint("merge"), ["h1", "h2", "rep"]).select("node", "text"), "texts")

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                found = list(shingle_sets(batch.column(1)))
                lists = _lists(np.concatenate(found), np.array([len(s) for s in found]))
                yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["node", "shingles"])

    return stored(texts.dropDuplicates(["node"]).mapInArrow(run, "node long, shingles array<long>"), "shingle sets")


def _compared(pairs: DataFrame, sets: DataFrame, apart: bool) -> DataFrame:
    """``(a, b, common, size_a, size_b, apart)``: the sizes, and with ``apart`` what only one of both has."""
    one = lambda x: sets.select(F.col("node").alias(x), F.col("shingles").alias(f"set_{x}"))
    both = pairs.select("a", "b").join(one("b").hint("merge"), "b").join(one("a").hint("merge"), "a").select("a", "b", "set_a", "set_b")

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                numbers, only = [], []
                for k in range(batch.num_rows):
                    x, y = (batch.column(c)[k].values.to_numpy() for c in (2, 3))
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    numbers.append((common, len(x), len(y)))
                    only.append(np.setxor1d(x, y, assume_unique=True) if apart else x[:0])
                columns = [pa.array(c, pa.int64()) for c in zip(*numbers)]
                lists = _lists(np.concatenate(only), np.array([len(o) for o in only]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), *columns, lists], names=["a", "b", "common", "size_a", "size_b", "apart"]
                )

    return both.mapInArrow(run, "a long, b long, common long, size_a long, size_b long, apart array<long>")


def _around_centres(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links within the groups of each pivot, and pairs that may link besides.

    ``members`` are rows of ``_compared`` with the pivot as ``b``. A group's centre is the set of the elements that more than
    half of its members have, its pivot too, or the pivot's set if most members link with that. Let a member of ``size`` elements differ from the centre in ``d``: two sets
    link if they differ in up to 15 / 185 of both sizes, so they do at once if the sum of both ``slack`` = 185 d - 15 size
    is 0 or less. If that is so for any partner, it is for the member of least slack. Other pairs need (slack + slack) / 370
    of their differences in common: at least 1. Pairs of members that link with that member need no comparison.
    """
    part, whole = SIMILAR
    plus, minus = whole + part, whole - part
    linked = F.count_if(_enough(F.col("common"), F.col("size_a"), F.col("size_b")))
    own = members.groupBy(F.col("b").alias("a")).agg(F.first("size_b").alias("size_a"), F.count(F.lit(1)).alias("n"), linked.alias("linked"))
    own = stored(own, "groups")
    rows = members.select("a", "b", F.col("size_a").alias("size"), "apart")
    rows = rows.union(own.select("a", F.col("a").alias("b"), "size_a", F.array().cast("array<bigint>")))
    # A pivot that most members link with is near the centre and serves as one.
    astray = own.where("2 * linked <= n").select(F.col("a").alias("b"), "n")
    often = members.select("b", "apart").join(astray, "b").select("b", "n", F.explode("apart").alias("element"))
    often = often.groupBy("b", "n", "element").agg(F.count(F.lit(1)).alias("times")).where(2 * F.col("times") > F.col("n") + 1)
    centres = stored(often.groupBy("b").agg(F.collect_list("element").alias("centre")), "centres")
    rows = rows.join(centres.hint("merge"), "b", "left")
    moved = F.concat(F.array_except("apart", "centre"), F.array_except("centre", "apart"))
    rows = rows.select("a", "b", "size", F.when(F.col("centre").isNull(), F.col("apart")).otherwise(moved).alias("apart"))
    rows = rows.withColumn("slack", plus * F.size("apart").cast("long") - minus * F.col("size"))
    rows = stored(rows.withColumn("member", F.monotonically_increasing_id()), "members")
    least = rows.groupBy("b").agg(F.min(F.struct("slack", "a")).alias("least"))
    rows = rows.join(stored(least, "least").hint("merge"), "b")
    close = F.col("slack") + F.col("least.slack") <= 0
    rows = stored(rows.select("member", "a", "b", "size", "slack", F.col("least.a").alias("centre"), close.alias("close"), "apart"), "members")
    links = rows.where("close and a <> centre").select("a", F.col("centre").alias("b"))
    rows = _with_partners(rows.drop("centre"))
    lists = _met(_differences(rows).select(F.col("member").alias("node"), "need", "key"))
    facts = rows.select(F.col("member").alias("node"), "a", "slack", "close", "shared")
    lists = stored(lists.select("key", "node").join(facts, "node"), "differences")
    x, y = lists.where("not close").alias("x"), lists.alias("y")
    # Two members that are both not close would meet twice.
    once = (F.col("x.a") != F.col("y.a")) & (F.col("y.close") | (F.col("x.a") < F.col("y.a")))
    possible = F.col("x.slack") + F.col("y.slack") <= 2 * plus * F.least("x.shared", "y.shared")
    pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & once & possible)
    return links, pairs.select(F.least("x.a", "y.a").alias("a"), F.greatest("x.a", "y.a").alias("b")).distinct()


def _differences(rows: DataFrame) -> DataFrame:
    kept = [c for c in rows.columns if c != "apart"]
    return rows.select(*kept, F.explode("apart").alias("element")).withColumn("key", F.xxhash64("b", "element")).drop("element")


#: Rounds of dropping members, as long as a round drops a tenth; more would only spare work.
ROUNDS = 3


def _with_partners(rows: DataFrame) -> DataFrame:
    """The members that may link with one that is not close, with ``need``, the differences that both must have in common, and
    ``shared``, the differences that any other member has as well.

    The more members go, the larger is the least slack of those left, and the more others go.
    """
    part, whole = SIMILAR
    plus, minus = whole + part, whole - part
    before = None
    for _ in range(ROUNDS):
        least = rows.groupBy("b").agg(F.min("slack").alias("any"), F.min(F.when(~F.col("close"), F.col("slack"))).alias("far"))
        least = stored(least.where("far is not null"), "least")
        kept = [c for c in rows.columns if c not in ("need", "shared")]
        rows = rows.select(*kept).join(least.hint("merge"), "b")
        partner = F.when(F.col("close"), F.col("far")).otherwise(F.col("any"))
        among = F.ceil((F.col("slack") + partner) / F.lit(2 * plus))
        # Differences can only be spared as far as the largest possible partner allows.
        need = F.greatest(among, F.size("apart") - F.floor(minus * F.col("size") / F.lit(part)), F.lit(1))
        rows = rows.select(*kept, need.cast("long").alias("need")).where(F.size("apart") >= F.col("need"))
        keys = _differences(rows.select("member", "b", "close", "apart"))
        common = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("close").alias("all_close"))
        common = stored(common.where("n > 1 and not all_close").select("key"), "common keys")
        shared = keys.select("member", "key").join(common, "key").groupBy("member").agg(F.count(F.lit(1)).alias("shared"))
        rows = stored(rows.join(shared, "member").where("shared >= need"), "members")
        left = rows.count()
        if not left or before and left > 0.9 * before:
            break
        before = left
    return rows


def _stars(lists: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(a, b)``: each member of a crowded list with the pivot of its group.

    Lists whose pivot is like a better known pivot, one of another list that it is in, join the group of that one, so a member
    is in few groups. Any set serves to tell the members of a group apart.
    """
    stars = lists.where("node <> pivot").groupBy(F.col("node").alias("a"), F.col("pivot").alias("b")).agg(F.max("known").alias("known"))
    stars = stored(stars, "stars")
    pivots = stars.select(F.col("b").alias("a")).distinct()
    pairs = stars.join(pivots, "a")
    alike = pairs.join(_with_matches(pairs.select("a", "b"), nodes), ["a", "b"])
    better = alike.groupBy(F.col("a").alias("b")).agg(F.max_by("b", F.struct("known", "b")).alias("to"))
    grouped = stars.join(stored(better, "pivots"), "b", "left").select("a", F.coalesce("to", "b").alias("b"))
    return stored(grouped.where("a <> b").distinct(), "stars")


def links(docs: DataFrame, nodes: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pairs ``(a, b)`` of nodes whose sets are similar enough, all or, in crowded lists, enough to connect the same nodes."""
    postings = nodes.select("node", F.lit(MATCHES).alias("need"), F.explode("signature").alias("key"))
    lists = _met(postings)
    x, y = lists.where(F.col("length") <= SHORT).alias("x"), lists.where(F.col("length") <= SHORT).alias("y")
    short = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node")))
    short = short.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    short = stored(_with_matches(short, nodes), "candidates")
    stars = _stars(lists.where(F.col("length") > SHORT), nodes)
    ends = short.union(stars).select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = _whole_sets(docs, id, text, nodes, ends)
    linked = _enough(F.col("common"), F.col("size_a"), F.col("size_b"))
    members = stored(_compared(stars, sets, apart=True), "members")
    near = stored(_compared(short, sets, apart=False).where(linked).select("a", "b"), "links")
    near = near.union(members.where(linked).select("a", "b"))
    if members.isEmpty():
        return near
    close, rest = _around_centres(members)
    near = stored(near.union(close), "links")
    # What is connected by now need not be compared.
    roots = components(near, "a", "b")
    for end in "ab":
        root = roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
        rest = rest.join(root, end, "left").withColumn(f"root_{end}", F.coalesce(f"root_{end}", end))
    rest = stored(_with_matches(rest.where("root_a <> root_b").select("a", "b"), nodes), "candidates")
    return near.union(_compared(rest, sets, apart=False).where(linked).select("a", "b"))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``n_shingles`` and ``component_id``, the smallest id that is reachable, of every row."""
    signed = stored(_scanned(docs, id, text, signatures=True), "signatures")
    sets = signed.where("size > 0").groupBy("h1", "h2", "size")
    nodes = sets.agg(F.min("id").alias("least"), F.min(F.xxhash64("id")).alias("rep"), F.first("signature").alias("signature"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "distinct sets")
    roots = components(links(docs, nodes, id, text), "a", "b")
    rooted = nodes.join(roots, "node", "left").select("h1", "h2", "least", F.coalesce("root", "node").alias("root"))
    rooted = stored(rooted, "classes")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = stored(rooted.join(least, "root").select("h1", "h2", "component_id"), "classes")
    # Texts without words are classes of their own and take no part in the join.
    alone = signed.where("size = 0").select(F.col("id").alias(id), F.col("size").alias("n_shingles"), F.col("id").alias("component_id"))
    rest = signed.where("size > 0").select("h1", "h2", "id", "size").join(classes, ["h1", "h2"])
    return rest.select(F.col("id").alias(id), F.col("size").alias("n_shingles"), "component_id").union(alone)


def query(documents: DataFrame) -> DataFrame:
    found = near_duplicates(documents.select("doc_id", "text"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


SQL = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[i : i + 2], ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS i FROM split WHERE len(words) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
    FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
    GROUP BY ALL
), near AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * common.n >= 85 * (x.n + y.n - common.n)
), reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT reach.doc_id, near.b FROM reach JOIN near ON near.a = reach.other
), least AS (
    SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN sizes USING (doc_id)
"""
