"""Exact top-k inner-product search by columnar branch-and-bound.

Vectors are packed into blocks; a block of candidates is laid out by dimension. For each query, partial scores accumulate
over one run of dimensions after the other; a candidate's final score is at most its partial score plus the product of
the remaining norms (Cauchy-Schwarz), and candidates that cannot reach the k-th best score so far are compacted away.
Candidate blocks lie in as many groups as there are blocks; every query block is sent to each group and streams past the
group's blocks, so a candidate moves once and no task holds all queries or candidates.

Components x become floor(scale * x). Vectors that are null or hold null or non-finite components take no part, neither
do those without an id; vectors of different lengths are not compared. Rows that repeat an id count one by one, as queries
and as candidates: a query leaves out its own row alone. Ties go to the smaller id. Scores beyond 64 bits are cut to the nearest bound.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoptrail.runtime import stored

K = 10
SCALE = 1024
#: Vectors of a candidate block and of a query block.
CANDIDATES, QUERIES = 8192, 512
#: Candidates that share one column layout, and dimensions that are accumulated before candidates are dropped.
LAYOUT, STEP = 2048, 16

def _joined(parts) -> bytes:
    return np.concatenate(parts).astype("<i8").tobytes()


def _candidate_blocks(vectors: DataFrame, most: int) -> DataFrame:
    """Blocks of at most ``most`` vectors of one length: ids, row-major components and which rows are queries (little-endian)."""

    def run(batches):
        for batch in batches:
            dims = np.asarray(batch.column(2))
            asked = batch.column(3).to_numpy(zero_copy_only=False)
            out = []
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                for part in np.array_split(rows, -(-len(rows) // most)):
                    values = batch.column(1).take(pa.array(part)).flatten().to_numpy(zero_copy_only=False)
                    ids = batch.column(0).take(pa.array(part)).to_numpy(zero_copy_only=False)
                    places = np.flatnonzero(asked[part]).astype("<i8").tobytes()
                    out.append((int(dim), ids.astype("<i8").tobytes(), values.astype("<i8").tobytes(), places))
            columns = list(zip(*out)) or [[], [], [], []]
            types = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
            names = ["dim", "ids", "vectors", "asked"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    packed = vectors.mapInArrow(run, "dim int, ids binary, vectors binary, asked binary")
    return packed.withColumn("block", F.monotonically_increasing_id())


def _query_blocks(candidates: DataFrame, most: int) -> DataFrame:
    """The queries among stored candidates in blocks of about ``most``, each with the block and place of its own row."""

    def run(batches):
        held: dict[int, list] = {}
        names = ["dim", "q_ids", "q_vectors", "q_blocks", "q_places"]
        types = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())

        def block(dim):
            columns = [dim, *[_joined(parts) for parts in zip(*held.pop(dim))]]
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(columns, types)], names=names)

        for batch in batches:
            for r in range(batch.num_rows):
                dim, ids, vecs, asked, number = (batch.column(c)[r].as_py() for c in range(5))
                places = np.frombuffer(asked, "<i8")
                ids = np.frombuffer(ids, "<i8")
                vecs = np.frombuffer(vecs, "<i8").reshape(len(ids), dim)
                for first in range(0, len(places), most):
                    part = places[first : first + most]
                    parts = held.setdefault(dim, [])
                    parts.append((ids[part], vecs[part].ravel(), np.full(len(part), number), part))
                    if sum(len(p[0]) for p in parts) >= most:
                        yield block(dim)
        for dim in list(held):
            yield block(dim)

    asked = candidates.where(F.length("asked") > 0).select("dim", "ids", "vectors", "asked", "block")
    packed = asked.mapInArrow(run, "dim int, q_ids binary, q_vectors binary, q_blocks binary, q_places binary")
    return packed.withColumn("q", F.monotonically_increasing_id())


def top_of_block(own_places, queries, ids, vectors, k: int = K, layout: int = LAYOUT, step: int = STEP):
    """Per query: ids and scores of the ``k`` best candidates, scores descending, ties to the smaller id.

    ``own_places`` says where in the block a query's own row stands, -1 where it is not in it.
    """
    dim = vectors.shape[1]
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(dim, 1)
    exact = np.float64 if largest < 2.0**52 else object  # sums of products stay whole numbers either way
    cuts = list(range(0, dim, step)) + [dim] if dim else [0, 0]
    rest_q = [np.sqrt((queries[:, c:].astype(np.float64) ** 2).sum(1)) for c in cuts]
    best: list = [(np.empty(0, np.int64), np.empty(0, exact)) for _ in own_places]
    for first in range(0, len(ids), layout):
        own = ids[first : first + layout]
        columns = np.ascontiguousarray(vectors[first : first + layout].T)
        rest = [np.sqrt((columns[c:].astype(np.float64) ** 2).sum(0)) for c in cuts]
        columns = columns.astype(exact)
        opening = queries[:, cuts[0] : cuts[1]].astype(exact) @ columns[cuts[0] : cuts[1]]
        for number, (own_place, query) in enumerate(zip(own_places, queries.astype(exact))):
            top_ids, top_scores = best[number]
            floor = float(top_scores[-1]) if len(top_scores) == k else -np.inf
            alive = np.flatnonzero(np.arange(first, first + len(own)) != own_place)
            partial = opening[number][alive]
            for a, b in zip(cuts[1:-1], cuts[2:]):
                if floor > -np.inf:
                    # A margin far above rounding keeps every candidate that could still tie.
                    bound = partial.astype(np.float64) + rest[cuts.index(a)][alive] * rest_q[cuts.index(a)][number] * (1 + 1e-9) + 1e-6
                    keep = bound >= floor * (1 - 1e-12 * np.sign(floor))
                    alive, partial = alive[keep], partial[keep]
                if not len(alive):
                    break
                partial = partial + query[a:b] @ columns[a:b, alive]
            if len(alive):
                all_ids, all_scores = np.concatenate([top_ids, own[alive]]), np.concatenate([top_scores, partial])
                if exact is object:
                    order = sorted(range(len(all_ids)), key=lambda i: (-all_scores[i], all_ids[i]))[:k]
                else:
                    order = np.lexsort((all_ids, -all_scores))[:k]
                best[number] = (all_ids[order], all_scores[order])
    return best


def top_k(
    vectors: DataFrame, is_query, id: str = "vec_id", vector: str = "embedding", k: int = K, scale: int = SCALE
) -> DataFrame:
    """Rows ``(query_id, rank, vec_id, score)`` for every row of ``vectors`` that satisfies ``is_query``."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col(id).isNotNull() & F.col(vector).isNotNull() & finite)
    rows = rows.select(F.col(id).cast("long").alias("id"), whole.alias("v"), F.size(vector).alias("dim"), F.coalesce(is_query, F.lit(False)).alias("q"))
    candidates = stored(_candidate_blocks(rows.select("id", "v", "dim", "q"), CANDIDATES), "candidate blocks")
    queries = stored(_query_blocks(candidates, QUERIES), "query blocks")
    # As many groups as blocks of a length: a group holds one block or a few. The size of the queries times the groups is
    # not known to the planner, so it must not take them for small enough to broadcast. The queries stream, on the left;
    # the blocks of a group are held.
    groups = candidates.groupBy("dim").agg(F.count(F.lit(1)).alias("groups"))
    sent = queries.join(groups, "dim").select("*", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group")).drop("groups")
    dealt = candidates.join(groups, "dim").select(
        "dim", F.pmod(F.xxhash64("block"), F.col("groups")).alias("group"), "block", "ids", "vectors"
    )
    met = sent.hint("merge").join(dealt, ["dim", "group"])

    def run(batches):
        for batch in batches:
            out = [], [], [], [], []
            for r in range(batch.num_rows):
                dim, ids, vecs, block, q_ids, q_vecs, q_blocks, q_places, q = (batch.column(c)[r].as_py() for c in range(9))
                ids, q_ids, q_blocks, q_places = (np.frombuffer(b, "<i8") for b in (ids, q_ids, q_blocks, q_places))
                vecs = np.frombuffer(vecs, "<i8").reshape(len(ids), dim)
                q_vecs = np.frombuffer(q_vecs, "<i8").reshape(len(q_ids), dim)
                own_places = np.where(q_blocks == block, q_places, -1)
                for n, (found, scores) in enumerate(top_of_block(own_places, q_vecs, ids, vecs, k)):
                    scores = [max(min(int(s), 2**63 - 1), -(2**63)) for s in scores]
                    for column, value in zip(out, (q, n, int(q_ids[n]), found.tolist(), scores)):
                        column.append(value)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=["q", "n", "query_id", "ids", "scores"])

    tops = met.select("dim", "ids", "vectors", "block", "q_ids", "q_vectors", "q_blocks", "q_places", "q").mapInArrow(
        run, "q long, n int, query_id long, ids array<bigint>, scores array<bigint>"
    )
    flat = tops.select("q", "n", "query_id", F.inline(F.arrays_zip("ids", "scores"))).toDF("q", "n", "query_id", "vec_id", "score")
    rank = F.row_number().over(W.partitionBy("q", "n").orderBy(F.desc("score"), "vec_id"))
    return flat.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(embeddings: DataFrame) -> DataFrame:
    return top_k(embeddings, F.col("vec_id") % 100 == 0)


#: DuckDB counterpart of ``query``.
SQL = """
WITH e AS (
  SELECT row_number() OVER () AS row_no, vec_id, [floor(x::DOUBLE * 1024)::BIGINT for x in embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.row_no, q.vec_id AS query_id, c.vec_id,
    list_inner_product([x::DOUBLE for x in q.v], [x::DOUBLE for x in c.v])::BIGINT AS score
  FROM e q JOIN e c ON q.row_no <> c.row_no AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY row_no ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""
