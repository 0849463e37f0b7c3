"""Language-model scores: an interpolated modified Kneser-Ney bigram model.

Tokens are the words of the lower-cased text (A-Z only) and one end per text. Tasks count bigrams of their texts as sorted
arrays of 64-bit hashes, combined before the shuffle; a shuffle by context brings a context's words together, and a second
one by word gives continuation counts and plain counts. Both kinds of groups are cut by hash ranges, whose number grows with
the text, so a frequent word adds one entry per task, not one per occurrence. The followers of a context that accounts for
more text than a range holds are dealt over several ranges, in proportion to that text; the parts of its totals meet in the
second shuffle. At most one context per range is that frequent, so their list is bounded by the number of ranges. The merged
groups are stored as sorted hash arrays, one raw file per range, in the shared folder; scoring workers map those files into
memory, once per worker, and look tokens up by binary search. Counts have 64 bits; what a bigram occurs beyond 32 bits is in
a file of its own.

A file is written under a temporary name and then renamed, so a repeated task leaves the same file. Words are known by
their 64-bit hashes. Order 2 is what the disk allows: distinct trigrams alone would be larger than the input.

Null texts are empty; an empty text is its end. Rows without an id are learned from and scored like any other. Without
training texts every token has probability 1 / (0 + 1).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.llm import scan
from shoptrail.llm.toxicity import held_out
from shoptrail.runtime import remove_at_exit, work_folder

START, END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
#: Bigrams that a task holds before it sorts and sends them.
PAIRS_AT_ONCE = 3_000_000
#: Text bytes for each hash range.
RANGE_BYTES = 16 << 20
#: The largest count that an entry of a bigram file holds.
MOST = 2**32 - 1

_PAIRS = [("hash", "<u8"), ("count", "<u4")]
_BEYOND = [("hash", "<u8"), ("more", "<u8")]
_CONTEXTS = [("hash", "<u8"), ("total", "<u8"), ("n1", "<u8"), ("n2", "<u8"), ("n3", "<u8")]
_WORDS = [("hash", "<u8"), ("count", "<u8"), ("contexts", "<u8")]


def tokens(column: pa.Array):
    """Per chunk: first row, the token hashes, those before them, and where each text's tokens begin."""
    for first, data, off in scan.chunks(column):
        data = scan.LOWER[data]
        starts, ends, owner = scan.words(data, off, scan.NOT_BLANK)
        begins = scan.first_of_runs(owner, len(off) - 1) + np.arange(len(off))
        current = np.full(begins[-1], END)
        current[np.arange(len(starts)) + owner] = scan.word_hashes(data, starts, ends)
        before = np.empty_like(current)
        before[1:] = current[:-1]
        before[begins[:-1]] = START
        yield first, current, before, begins


def pair_hashes(before: np.ndarray, current: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return scan.mix(before * np.uint64(0x9E3779B97F4A7C15) + current)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin, in sorted arrays."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def _combined(before: np.ndarray, current: np.ndarray, count: np.ndarray | None = None):
    """Distinct bigrams sorted by context and word, with their counts."""
    order = np.lexsort((current, before))
    before, current = before[order], current[order]
    at = _runs(before, current)
    if count is None:
        return before[at], current[at], np.diff(np.append(at, len(before)))
    return before[at], current[at], np.add.reduceat(count[order], at) if len(at) else count[:0]


def _cut(of: np.ndarray):
    """``(range, first, last)`` of the ranges that occur in sorted range numbers."""
    at = np.append(_runs(of), len(of)) if len(of) else [0]
    return [(int(of[a]), a, b) for a, b in zip(at[:-1], at[1:])]


class Ranges:
    """Which hash range an entry belongs to.

    Words and contexts go by their leading ``bits``; the followers of a context in ``spread`` (context hash to number of
    ranges) go to that many ranges from there on.
    """

    def __init__(self, bits: int, spread: dict[int, int]):
        self.bits, self.spread = bits, spread
        self.hashes = np.array(sorted(spread), "<u8")
        self.parts = np.array([spread[h] for h in sorted(spread)], "<u8")

    def of(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    def _place(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.hashes):
            return np.zeros(len(contexts), bool), np.zeros(len(contexts), np.int64)
        place = np.minimum(np.searchsorted(self.hashes, contexts), len(self.hashes) - 1)
        return self.hashes[place] == contexts, place

    def is_spread(self, contexts: np.ndarray) -> np.ndarray:
        return self._place(contexts)[0]

    def of_pairs(self, before: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        of = self.of(before)
        spread, place = self._place(before)
        of[spread] += (pairs[spread] % self.parts[place[spread]]).astype(np.int64)
        return of & ((1 << self.bits) - 1)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int32() if n == "range" else pa.binary()) for c, n in zip(columns, names)], names=names)


def _frequent(texts: DataFrame, n_bytes: int, bits: int) -> dict[int, int]:
    """Contexts that account for more text than a range holds, and over how many ranges to deal their followers.

    A part of the texts names the contexts with at least a range's share of it, each with its share of the part's bytes, so
    what goes unnamed of a context is less than one range.
    """
    names = ["context", "bytes"]

    def named(parts, size):
        contexts, n = np.unique(np.concatenate(parts), return_counts=True)
        total = int(n.sum())
        often = n >= total / 2**bits
        share = (n[often] * (size / total)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(contexts[often].view(np.int64)), pa.array(share)], names=names)

    def run(batches):
        parts, n, size = [], 0, 0
        for batch in batches:
            for _, _, before, _ in tokens(batch.column(0)):
                parts.append(before)
                n += len(before)
            size += batch.column(0).nbytes
            if n >= PAIRS_AT_ONCE:
                yield named(parts, size)
                parts, n, size = [], 0, 0
        if parts:
            yield named(parts, size)

    range_bytes = n_bytes / 2**bits
    found = texts.mapInArrow(run, "context long, bytes long").groupBy("context").agg(F.sum("bytes").alias("bytes"))
    rows = found.where(F.col("bytes") > range_bytes).collect()
    return {int(np.int64(r["context"]).view(np.uint64)): min(int(np.ceil(r["bytes"] / range_bytes)), 2**bits) for r in rows}


def _bigrams(texts: DataFrame, ranges: Ranges) -> DataFrame:
    names = ["range", "contexts", "sizes", "words", "counts"]

    def packed(parts):
        before, current, count = _combined(*(np.concatenate(p) for p in zip(*parts)))
        of_pairs = ranges.of_pairs(before, pair_hashes(before, current))
        order = np.argsort(of_pairs, kind="stable")
        before, current, count, of_pairs = before[order], current[order], count[order], of_pairs[order]
        rows = []
        for of, a, b in _cut(of_pairs):
            at = _runs(before[a:b])
            sizes = np.diff(np.append(at, b - a))
            rows.append((of, before[a:b][at].tobytes(), sizes.astype("<u4").tobytes(), current[a:b].tobytes(), count[a:b].astype("<u4").tobytes()))
        return _batch(rows, names)

    def run(batches):
        parts, n = [], 0
        for batch in batches:
            for _, current, before, _ in tokens(batch.column(0)):
                parts.append((before, current))
                n += len(current)
                if n >= PAIRS_AT_ONCE:
                    yield packed(parts)
                    parts, n = [], 0
        if parts:
            yield packed(parts)

    return texts.mapInArrow(run, "range int, contexts binary, sizes binary, words binary, counts binary")


def _joined(column, kind: str) -> np.ndarray:
    return np.concatenate([np.frombuffer(b.as_buffer(), kind) for b in column] or [np.empty(0, kind)])


def _local(path: str) -> str | None:
    parsed = urlparse(path)
    return parsed.path if parsed.scheme in ("", "file") else None


def write_arrays(path: str, arrays: list[np.ndarray]) -> None:
    """One file of the arrays one after the other; it appears complete or not at all."""
    other = f"{path}.{uuid.uuid4().hex}"
    if local := _local(path):
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(_local(other), "wb") as file:
            for a in arrays:
                file.write(memoryview(np.ascontiguousarray(a)).cast("B"))
        os.replace(_local(other), local)
        return
    from pyarrow import fs

    system, base = fs.FileSystem.from_uri(path)
    temporary = fs.FileSystem.from_uri(other)[1]
    system.create_dir(os.path.dirname(base), recursive=True)
    with system.open_output_stream(temporary) as file:
        for a in arrays:
            file.write(np.ascontiguousarray(a).tobytes())
    system.move(temporary, base)


def map_arrays(path: str, layout: list[tuple[str, str]]) -> dict[str, np.ndarray]:
    """The arrays of a file, mapped into memory; a remote file is mapped from an unlinked local copy."""
    if local := _local(path):
        raw = np.memmap(local, np.uint8, "r") if os.path.getsize(local) else np.empty(0, np.uint8)
    else:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(path)
        with tempfile.TemporaryFile() as copy, system.open_input_stream(base) as file:
            while block := file.read(1 << 22):
                copy.write(block)
            copy.flush()
            raw = np.memmap(copy, np.uint8, "r") if copy.tell() else np.empty(0, np.uint8)
    n = len(raw) // sum(np.dtype(kind).itemsize for _, kind in layout)
    out, at = {}, 0
    for name, kind in layout:
        size = n * np.dtype(kind).itemsize
        out[name], at = raw[at : at + size].view(kind), at + size
    return out


def _stats(counts: np.ndarray) -> list[int]:
    return [int(np.count_nonzero(counts == k)) for k in (1, 2, 3, 4)]


def _contexts_of_range(folder: str, ranges: Ranges):
    """Store a range of contexts and pass on its words: how many contexts and occurrences each has there.

    The totals of spread contexts are passed on too, and the bigrams' counts of counts.
    """
    names = ["range", "words", "contexts", "counts", "totals", "stats"]

    def run(table: pa.Table) -> pa.Table:
        of = table["range"][0].as_py()
        before = np.repeat(_joined(table["contexts"], "<u8"), _joined(table["sizes"], "<u4"))
        before, current, count = _combined(before, _joined(table["words"], "<u8"), _joined(table["counts"], "<u4").astype(np.int64))
        pairs = pair_hashes(before, current)
        order = np.argsort(pairs)
        write_arrays(f"{folder}/pairs-{of:04d}", [pairs[order], np.minimum(count[order], MOST).astype("<u4")])
        beyond = order[count[order] > MOST]
        if len(beyond):
            write_arrays(f"{folder}/beyond-{of:04d}", [pairs[beyond], (count[beyond] - MOST).astype("<u8")])
        at = _runs(before)
        kinds = (count, count == 1, count == 2, count > 2)
        totals = np.stack([before[at], *(np.add.reduceat(k.astype("<u8"), at) for k in kinds)])
        spread = ranges.is_spread(before[at])
        write_arrays(f"{folder}/contexts-{of:04d}", list(totals[:, ~spread]))
        rows = [
            (r, b"", b"", b"", totals[:, spread][:, a:b].T.tobytes(), b"")
            for r, a, b in _cut(ranges.of(totals[0, spread]))
        ]
        order = np.argsort(current, kind="stable")
        current, per_word = current[order], count[order]
        at = _runs(current)
        words, contexts, counts = current[at], np.diff(np.append(at, len(current))), np.add.reduceat(per_word, at)
        rows += [
            (r, words[a:b].tobytes(), contexts[a:b].astype("<u4").tobytes(), counts[a:b].astype("<u8").tobytes(), b"", b"")
            for r, a, b in _cut(ranges.of(words))
        ]
        rows.append((of, b"", b"", b"", b"", np.array([*_stats(count), len(beyond)], "<u8").tobytes()))
        return pa.Table.from_batches([_batch(rows, names)])

    return run


_SUMS = ["p1", "p2", "p3", "p4", "beyond", "w1", "w2", "w3", "w4", "vocabulary", "tokens", "bigrams"]


def _words_of_range(folder: str):
    """Store a range of words and one of spread contexts; gives the sums that describe the model."""

    def run(table: pa.Table) -> pa.Table:
        of = table["range"][0].as_py()
        pairs = _joined(table["stats"], "<u8").reshape(-1, 5).sum(0).tolist()
        totals = _joined(table["totals"], "<u8").reshape(-1, 5)
        if len(totals):
            totals = totals[np.argsort(totals[:, 0], kind="stable")]
            at = _runs(totals[:, 0])
            write_arrays(f"{folder}/spread-{of:04d}", [totals[at, 0], *np.add.reduceat(totals[:, 1:], at).T])
        words = _joined(table["words"], "<u8")
        stats = [0] * 7
        if len(words):
            order = np.argsort(words, kind="stable")
            words = words[order]
            at = _runs(words)
            contexts = np.add.reduceat(_joined(table["contexts"], "<u4")[order].astype(np.int64), at)
            counts = np.add.reduceat(_joined(table["counts"], "<u8")[order], at)
            write_arrays(f"{folder}/words-{of:04d}", [words[at], counts, contexts.astype("<u8")])
            stats = [*_stats(contexts), len(at), int(counts.sum()), int(contexts.sum())]
        return pa.table({name: pa.array([int(n)], pa.int64()) for name, n in zip(_SUMS, pairs + stats)})

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Discounts for counts 0, 1, 2 and more, from the numbers of entries with counts 1 to 4."""
    if not (n1 and n2 and n3):
        return [0.0, 0.5, 0.5, 0.5]  # too little text to estimate them
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return [0.0, *(min(max(d, 0.0), k - 0.05) for k, d in enumerate(raw, 1))]


def train(texts: DataFrame, text: str = "text", folder: str | None = None) -> dict:
    """Count, store and describe a model; what reaches the driver is one row of sums and the contexts to spread.

    Without a ``folder`` of its own the model goes with the driver's process.
    """
    spark = texts.sparkSession
    kept, folder = folder is not None, folder or work_folder(spark, "language-model")
    texts = texts.select(text)
    n_bytes = texts.agg(F.sum(F.octet_length(text))).first()[0] or 0
    bits = int(np.ceil(np.log2(max(n_bytes / RANGE_BYTES, 16))))
    spread = _frequent(texts, n_bytes, bits) if n_bytes else {}
    ranges = Ranges(bits, spread)
    words = _bigrams(texts, ranges).groupBy("range").applyInArrow(
        _contexts_of_range(folder, ranges), "range int, words binary, contexts binary, counts binary, totals binary, stats binary"
    )
    done = words.groupBy("range").applyInArrow(_words_of_range(folder), ", ".join(f"{name} long" for name in _SUMS))
    found = done.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in _SUMS]).first()
    if found["tokens"] and not kept:
        remove_at_exit(spark, folder)
    pairs, word_stats = [found[f"p{k}"] for k in (1, 2, 3, 4)], [found[f"w{k}"] for k in (1, 2, 3, 4)]
    return {"folder": folder, "bits": bits, "spread": spread, "beyond": found["beyond"],
            "pair_discounts": discounts(*pairs), "word_discounts": discounts(*word_stats), "word_stats": word_stats,
            "vocabulary": found["vocabulary"], "tokens": found["tokens"], "bigrams": found["bigrams"]}


#: The files that this process has mapped, of one model at a time.
_mapped: dict[str, dict] = {}


class Scorer:
    """Looks tokens up in the mapped files of a model."""

    def __init__(self, model: dict):
        self.model, self.ranges = model, Ranges(model["bits"], model["spread"])
        if model["folder"] not in _mapped:
            _mapped.clear()
        self.maps = _mapped.setdefault(model["folder"], {})
        d, n = model["word_discounts"], model["word_stats"]
        bigrams, vocabulary = model["bigrams"], model["vocabulary"]
        held = d[1] * n[0] + d[2] * n[1] + d[3] * (vocabulary - n[0] - n[1])
        #: What every word gets at the lowest level, also one that is not known.
        self.uniform = (held / bigrams if bigrams else 1.0) / (vocabulary + 1)

    def _arrays(self, kind: str, of: int, layout) -> dict[str, np.ndarray]:
        key = kind, of
        if key not in self.maps:
            path = f"{self.model['folder']}/{kind}-{of:04d}"
            try:
                self.maps[key] = map_arrays(path, layout)
            except FileNotFoundError:  # no text has anything in this range
                self.maps[key] = {name: np.empty(0, t) for name, t in layout}
        return self.maps[key]

    def _look_up(self, kind: str, layout, of: np.ndarray, hashes: np.ndarray) -> dict[str, np.ndarray]:
        """The values of each hash in the file of its range, 0 where it is not there."""
        out = {name: np.zeros(len(hashes)) for name, _ in layout[1:]}
        order = np.lexsort((hashes, of))
        at = np.append(_runs(of[order]), len(of)) if len(of) else [0]
        for a, b in zip(at[:-1], at[1:]):
            rows = order[a:b]
            arrays = self._arrays(kind, int(of[rows[0]]), layout)
            table, wanted = arrays["hash"], hashes[rows]
            if not len(table):
                continue
            place = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
            there = table[place] == wanted
            for name in out:
                out[name][rows[there]] = arrays[name][place[there]]
        return out

    def __call__(self, current: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per token: probability by the model, and its count in the training texts."""
        m, ranges = self.model, self.ranges
        words, number = np.unique(current, return_inverse=True)
        word = self._look_up("words", _WORDS, ranges.of(words), words)
        d = np.array(m["word_discounts"])
        low = (word["contexts"] - d[np.minimum(word["contexts"], 3).astype(int)]) / max(m["bigrams"], 1) + self.uniform
        contexts, of_context = np.unique(before, return_inverse=True)
        context = self._look_up("contexts", _CONTEXTS, ranges.of(contexts), contexts)
        spread = ranges.is_spread(contexts)
        for name, values in self._look_up("spread", _CONTEXTS, ranges.of(contexts[spread]), contexts[spread]).items():
            context[name][spread] = values
        d = np.array(m["pair_discounts"])
        held = d[1] * context["n1"] + d[2] * context["n2"] + d[3] * context["n3"]
        weight = np.where(context["total"] > 0, held / np.maximum(context["total"], 1), 1.0)
        pair, of_pair = np.unique(pair_hashes(before, current), return_index=True)
        of = ranges.of_pairs(before[of_pair], pair)
        found = self._look_up("pairs", _PAIRS, of, pair)["count"]
        if m["beyond"]:
            found += self._look_up("beyond", _BEYOND, of, pair)["more"]
        count = found[np.searchsorted(pair, pair_hashes(before, current))]
        high = (count - d[np.minimum(count, 3).astype(int)]) / np.maximum(context["total"], 1)[of_context]
        return high + weight[of_context] * low[number], word["count"][number]


def scored(docs: DataFrame, model: dict, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_tokens, n_known, base_score and score (log10 probabilities)."""
    lean = docs.select(id, text)

    def run(batches):
        scorer = Scorer(model)
        floor = model["tokens"] + model["vocabulary"] + 1
        for batch in batches:
            n = batch.num_rows
            n_tokens, n_known, base, score = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
            for first, current, before, begins in tokens(batch.column(1)):
                probability, count = scorer(current, before)
                rows, at = slice(first, first + len(begins) - 1), begins[:-1]
                n_tokens[rows] = np.diff(begins)
                n_known[rows] = np.add.reduceat((count > 0).astype(np.int64), at)
                base[rows] = np.add.reduceat(np.log10((count + 1) / floor), at)
                score[rows] = np.add.reduceat(np.log10(probability), at)
            columns = [batch.column(0), *map(pa.array, (n_tokens, n_known, base, score))]
            yield pa.RecordBatch.from_arrays(columns, names=[id, "n_tokens", "n_known", "base_score", "score"])

    schema = docs.select(id).schema.add("n_tokens", "long").add("n_known", "long").add("base_score", "double").add("score", "double")
    return lean.mapInArrow(run, schema)


def query(documents: DataFrame) -> DataFrame:
    kept_out = held_out(F.col("doc_id"), 7, 2)
    model = train(documents.where(~kept_out))
    found = scored(documents, model)
    return found.select(
        "doc_id", kept_out.alias("held_out"), "n_tokens", "n_known", F.lit(model["tokens"]).cast("long").alias("train_tokens"), "base_score", "score"
    )
