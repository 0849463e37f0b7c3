"""Repeats inside a text: every run of words that repeat with some period, and the text with the repeats taken out.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are the same), at least ``2 q`` and at
least ``MIN_WORDS`` words long, that no neighbouring word extends. All runs of a text are found, by string synchronising sets:

* Periods below 3 * ``FIRST_SCALE`` are read off directly: stretches where each word equals the one ``q`` words on. They also
  say where a text is highly periodic.
* At scale t = 4, 8, 16, ... a position is *selected* if the hash of the t words there, or t words on, is the least among the
  hashes of the t + 1 positions from it on. Contexts of t words with a period up to t / 3 have no hash. Whether a position
  is selected depends on the 2 t words from it on alone, so a repeat of these words is selected as well. Selected positions
  with equal contexts, from 3 t to 6 t words apart, propose their distance as a period; as no such context repeats within t / 3
  words, each position has fewer than 18 partners.
* A run of which this sees nothing starts and ends in two highly periodic regions of one period ``r`` that touch or overlap.
  Such regions, found at smaller scales, propose the distances at which their patterns agree.

Each proposal grows left and right as far as words agree, by hashes of 1, 2, 4, ... words; what stays shorter than two
periods is dropped. A text's work grows as n log n in its words, and so does a task's memory in the words of its longest text.
Texts are scanned where they lie: nothing is shuffled.

Null and empty texts have no words and no runs. Repeated rows, equal and null ids stay separate rows; an empty table gives an
empty result. Other columns of the table are left out by ``query`` and kept by ``repeats`` and ``collapsed``.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shoptrail.llm import scan
from shoptrail.llm.columns import quoted

MIN_WORDS = 12
FIRST_SCALE = 4
_NEVER = np.uint64(2**64 - 1)
_NONE = np.empty((0, 3), np.int64)


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]]).view(np.int8)))
    return edges[::2], edges[1::2]


class _Hashes:
    """Hashes of 1, 2, 4, ... consecutive words."""

    def __init__(self, words: np.ndarray):
        self.n, self.levels = len(words), [words]

    def level(self, k: int) -> np.ndarray:
        while len(self.levels) <= k:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            with np.errstate(over="ignore"):
                self.levels.append(scan.mix(last[:-half] * np.uint64(0x9E3779B97F4A7C15) + last[half:]))
        return self.levels[k]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words agree from positions a < b on."""
        a, b, at = a.copy(), b.copy(), a
        for k in reversed(range(max(1, self.n.bit_length() - 1))):
            h = self.level(k)
            inside = b < len(h)
            same = np.zeros(len(a), bool)
            same[inside] = h[a[inside]] == h[b[inside]]
            a[same] += 1 << k
            b[same] += 1 << k
        return a - at

    def common_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words agree just before positions a < b."""
        a, b, at = a.copy(), b.copy(), a
        for k in reversed(range(max(1, self.n.bit_length() - 1))):
            h, step = self.level(k), 1 << k
            inside = a >= step
            same = np.zeros(len(a), bool)
            same[inside] = h[a[inside] - step] == h[b[inside] - step]
            a[same] -= step
            b[same] -= step
        return at - a


def _grown(hashes: _Hashes, at: np.ndarray, period: np.ndarray) -> np.ndarray:
    """The runs ``(start, end, period)`` around proposals that are two periods long at least."""
    at, period = np.unique(np.stack([at, period]), axis=1)
    start = at - hashes.common_before(at, at + period)
    end = at + period + hashes.common(at, at + period)
    return np.stack([start, end, period], axis=1)[end - start >= 2 * period]


def _selected(hashes: _Hashes, found: np.ndarray, k: int) -> np.ndarray:
    """The synchronising positions at scale 2^k; ``found`` has all runs of periods up to a third of it."""
    t = 1 << k
    value = hashes.level(k).copy()
    value[value == _NEVER] -= np.uint64(1)
    regions = found[(found[:, 2] <= t // 3) & (found[:, 1] - found[:, 0] >= t)]
    if len(regions):
        change = np.zeros(len(value) + 1, np.int64)
        np.add.at(change, regions[:, 0], 1)
        np.add.at(change, regions[:, 1] - t + 1, -1)
        value[np.cumsum(change)[:-1] > 0] = _NEVER
    least = value
    for step in range(k):
        half = 1 << step
        least = np.minimum(least[:-half], least[half:])
    least = np.minimum(least[:-1], value[t:])
    return np.flatnonzero((least != _NEVER) & ((value[: len(least)] == least) | (value[t:] == least)))


def _from_contexts(hashes: _Hashes, found: np.ndarray, k: int) -> np.ndarray:
    t = 1 << k
    at = _selected(hashes, found, k)
    context = hashes.level(k + 1)[at]
    order = np.lexsort((at, context))
    at, context = at[order], context[order]
    starts, periods = [], []
    for ahead in range(1, len(at)):
        apart = at[ahead:] - at[:-ahead]
        near = (context[ahead:] == context[:-ahead]) & (apart < 6 * t)
        if not near.any():
            break
        wide = near & (apart >= 3 * t)
        starts.append(at[:-ahead][wide])
        periods.append(apart[wide])
    return _grown(hashes, np.concatenate(starts), np.concatenate(periods)) if starts else _NONE


def _from_regions(hashes: _Hashes, found: np.ndarray, k: int) -> np.ndarray:
    """Runs of periods from 3 to 6 times the scale across two regions of one period up to a third of the scale."""
    t = 1 << k
    small = found[(found[:, 2] <= t // 3) & (found[:, 1] - found[:, 0] >= 3 * t)]
    if len(small) < 2:
        return _NONE
    small = small[np.lexsort((small[:, 0], small[:, 2]))]
    left, right = small[:-1], small[1:]
    touch = (left[:, 2] == right[:, 2]) & (right[:, 0] <= left[:, 1])
    starts, periods = [], []
    for (s1, e1, r), (s2, e2, _) in zip(left[touch].tolist(), right[touch].tolist()):
        # Where in the left region its pattern is that of the right one: the same residue of all periods across both.
        phases = s1 + np.arange(r)
        agree = np.flatnonzero(hashes.common(phases, np.full(r, s2)) >= r)
        for phase in agree.tolist():
            step = (s2 - s1 - phase) % r
            q = np.arange(3 * t + (step - 3 * t) % r, min(6 * t - 1, e1 - s1, e2 - s2) + 1, r)
            starts.append(np.maximum(s1, s2 - q))
            periods.append(q)
    return _grown(hashes, np.concatenate(starts), np.concatenate(periods)) if starts else _NONE


def runs_of(words: np.ndarray, longest: int) -> np.ndarray:
    """The runs ``(start, end, period)`` of two periods or more, sorted, in an array of word hashes.

    Several texts may follow each other, parted by values that stand nowhere else; ``longest`` is the most words of one.
    """
    hashes, found = _Hashes(words), [_NONE]
    for q in range(1, min(3 * FIRST_SCALE, longest // 2 + 1)):
        start, end = _stretches(words[:-q] == words[q:])
        long = end - start >= q
        found.append(np.stack([start[long], end[long] + q, np.full(long.sum(), q)], axis=1))
    known = _least(np.concatenate(found))
    k = FIRST_SCALE.bit_length() - 1
    while 6 << k <= longest:
        more = [_from_contexts(hashes, known, k), _from_regions(hashes, known, k)]
        known = _least(np.concatenate([known, *more]))
        k += 1
    return known


def _least(found: np.ndarray) -> np.ndarray:
    """Each stretch once, with its smallest period, sorted by start and period."""
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    first = np.ones(len(found), bool)
    first[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    found = found[first]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _planted(n: int, doc_id: int | None) -> np.ndarray | None:
    """Which original word each word becomes, if the document's checksum says that words are repeated."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


def _scanned(column: pa.Array, ids: pa.Array | None):
    """Per text: its words as ``(bytes, starts, ends)`` and its runs, numbered from the text's first word."""
    for first, data, off in scan.chunks(column):
        raw = data.tobytes()
        starts, ends, owner = scan.words(data, off, scan.NOT_BLANK)
        bounds = scan.first_of_runs(owner, len(off) - 1)
        n_words = np.diff(bounds)
        if ids is not None:
            for k in np.flatnonzero(n_words):
                to = _planted(int(n_words[k]), ids[first + int(k)].as_py())
                if to is not None:
                    here = slice(bounds[k], bounds[k + 1])
                    starts[here], ends[here] = starts[here][to], ends[here][to]
        hashes = scan.word_hashes(data, starts, ends)
        # One value of its own after each text; distinct values of small words could only meet by a hash collision.
        place = np.arange(len(hashes)) + owner
        line = scan.mix(np.arange(len(hashes) + len(n_words), dtype=np.uint64) + np.uint64(0xD1B54A32D192ED03))
        line[place] = hashes
        found = runs_of(line, int(n_words.max(initial=0)))
        found = found[found[:, 1] - found[:, 0] >= MIN_WORDS]
        begin = bounds[:-1] + np.arange(len(n_words))
        split = np.searchsorted(found[:, 0], np.append(begin, len(line)))
        for k in range(len(n_words)):
            here = slice(bounds[k], bounds[k + 1])
            mine = found[split[k] : split[k + 1]].copy()
            mine[:, :2] -= begin[k]
            yield raw, starts[here], ends[here], mine


def _kept(n: int, found: np.ndarray) -> np.ndarray:
    """The words that no run contains after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 1], -1)
    return np.cumsum(change)[:-1] == 0


def _joined(raw: bytes, starts: np.ndarray, ends: np.ndarray, kept: np.ndarray) -> bytes:
    return b" ".join([raw[a:b] for a, b in zip(starts[kept].tolist(), ends[kept].tolist())])


_RUN = ("start", "length", "period")


def repeats(docs: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """All columns of ``docs``, the runs of each text (by start, then period), and its words without the repeats.

    The two new columns must have names that ``docs`` does not have.
    """
    names = [c for c in docs.columns if c != text] + [text]
    rows = docs.select(*[quoted(c) for c in names])
    run_type = T.StructType([T.StructField(name, T.LongType()) for name in _RUN])
    added = [T.StructField(runs, T.ArrayType(run_type)), T.StructField(collapsed, T.StringType())]

    def run(batches):
        for batch in batches:
            found, texts = [], []
            for raw, starts, ends, mine in _scanned(batch.column(len(names) - 1), None):
                found.append([dict(zip(_RUN, (s, e - s, q))) for s, e, q in mine.tolist()])
                texts.append(_joined(raw, starts, ends, _kept(len(starts), mine)).decode())
            lists = pa.array(found, pa.list_(pa.struct([(name, pa.int64()) for name in _RUN])))
            columns = [*batch.columns, lists, pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, runs, collapsed])

    out = rows.mapInArrow(run, T.StructType([*rows.schema, *added]))
    return out.select(*[quoted(c) for c in [*docs.columns, runs, collapsed]])


RESULT = (
    "doc_id {id}, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)


def query(documents: DataFrame) -> DataFrame:
    """Digest of the runs of every document; documents whose checksum says so are given repeated words first.

    A null id has no checksum and its text stays as it is. ``start`` to ``exponent_milli`` describe the longest run (ties:
    smallest start, then period) and are null without one.
    """
    rows = documents.select("doc_id", "text")

    def run(batches):
        for batch in batches:
            ids, out = batch.column(0), []
            for raw, starts, ends, mine in _scanned(batch.column(1), ids):
                lengths = mine[:, 1] - mine[:, 0]
                listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in mine.tolist())
                best = (None,) * 4
                if len(mine):
                    k = int(np.argmax(lengths))
                    start, length, period = int(mine[k, 0]), int(lengths[k]), int(mine[k, 2])
                    best = (start, length, period, 1000 * length // period)
                digest = hashlib.sha256(_joined(raw, starts, ends, _kept(len(starts), mine))).hexdigest()
                out.append((len(mine), *best, hashlib.sha256(listed.encode()).hexdigest(), digest))
            columns = list(zip(*out)) if out else [()] * 7
            types = [pa.int64()] * 5 + [pa.string()] * 2
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
            yield pa.RecordBatch.from_arrays([ids, *arrays], names=["doc_id", *names])

    return rows.mapInArrow(run, RESULT.format(id=rows.schema["doc_id"].dataType.simpleString()))
