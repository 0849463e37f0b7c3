"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages. Every passage is encoded by a row of dense text features and one hidden layer; gated
attention (tanh and sigmoid branches) weighs the passages, and the weighted mean of the encodings is classified. Only
document labels are needed, the attention finds the passages that matter.

A passage has ``PASSAGE_WORDS`` words, or more in a text of over ``PASSAGES`` passages, so bags are bounded while every word
of the text counts. The network is fitted on a sample of the labelled rows whose expected size ``SAMPLE`` is a parameter;
scoring runs in the tasks that scan the texts. Labels, language, source and id are no inputs of a score.

Null and empty texts are bags of one all-zero passage. Without labelled rows every score is 1 (nothing is rejected); with
rows of one label only it is that label. Several labels of one id count as good only if all of them are 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptrail.llm import scan
from shoptrail.llm.columns import all_of, quoted, unused
from shoptrail.llm.toxicity import held_out
from shoptrail.runtime import stored

PASSAGE_WORDS, PASSAGES = 64, 256
#: Texts whose passages are held at once.
TEXTS_AT_ONCE = 256
#: Expected number of labelled rows to fit on.
SAMPLE = 8_000
#: Scores from which a document is accepted.
ACCEPTED = 0.7
HIDDEN, ATTENTION, EPOCHS, BATCH, RATE = 24, 12, 30, 64, 0.01

_B = np.arange(256)
_UPPER = (_B >= 0x41) & (_B <= 0x5A)
_DIGIT = (_B >= 0x30) & (_B <= 0x39)
_LETTER = _UPPER | ((_B >= 0x61) & (_B <= 0x7A)) | (_B >= 0x80)
_CLASSES = [_UPPER, _DIGIT, _LETTER, _B >= 0x80, _B == 0x0A, np.isin(_B, [*b".?!"]), np.isin(_B, [*b",;:"]), _B == 0x21, _B == 0x7C,
            np.isin(_B, [*b"#$%&*@^~_=+<>/\\{}[]|"]), np.isin(_B, [*b"aeiouyAEIOUY"]), ~scan.NOT_BLANK]
FEATURE_COUNT = len(_CLASSES) + 8


def passages_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of a batch and the text number of each; every text has at least one passage."""
    features, owners = [], []
    for first, raw, off in scan.chunks(column):
        n = len(off) - 1
        starts, ends, owner = scan.words(raw, off, scan.NOT_BLANK)
        bounds = scan.first_of_runs(owner, n)
        n_words = np.diff(bounds)
        size = np.maximum(PASSAGE_WORDS, -(-n_words // PASSAGES))
        n_passages = np.maximum(-(-n_words // size), 1)
        of_text = np.repeat(np.arange(n), n_passages)
        number = np.arange(len(of_text)) - np.repeat(np.cumsum(n_passages) - n_passages, n_passages)
        begin = bounds[of_text] + number * size[of_text]
        end = np.minimum(begin + size[of_text], bounds[of_text + 1])
        word_count = end - begin
        # Passages cover all bytes: each ends where the next begins, the first and last reach the text's bounds.
        starts_and_end = np.append(starts, len(raw))
        byte_begin = np.where(number == 0, off[of_text], starts_and_end[begin])
        byte_end = np.where(number == n_passages[of_text] - 1, off[of_text + 1], starts_and_end[end])
        n_bytes = np.maximum(byte_end - byte_begin, 1)
        columns = []
        for table in _CLASSES:
            total = np.concatenate([[0], np.cumsum(table[raw])])
            columns.append((total[byte_end] - total[byte_begin]) / n_bytes)
        hashes = scan.word_hashes(scan.LOWER[raw], starts, ends)
        lengths = ends - starts
        per_word = 1 / np.maximum(word_count, 1)
        sums = lambda values: (lambda t: t[end] - t[begin])(np.concatenate([[0], np.cumsum(values)]))
        passage_of_word = np.repeat(np.arange(len(of_text)), word_count)
        same = np.zeros(len(hashes), bool)
        same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
        order = np.lexsort((hashes, passage_of_word))
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (passage_of_word[order][1:] != passage_of_word[order][:-1])
        distinct = np.bincount(passage_of_word[order][fresh], minlength=len(of_text))
        # Pairs of words that the same text has had before.
        pair = scan.shingle_hashes(hashes, 2)
        pair_owner = owner[: len(pair)]
        order = np.lexsort((np.arange(len(pair)), pair, pair_owner))
        seen = np.zeros(len(hashes), bool)
        again = (pair[order][1:] == pair[order][:-1]) & (pair_owner[order][1:] == pair_owner[order][:-1])
        seen[order[1:][again]] = True
        # A word without any letter, and one that is all capitals.
        letters = np.concatenate([[0], np.cumsum(_LETTER[raw])])
        capitals = np.concatenate([[0], np.cumsum(_UPPER[raw])])
        own_letters, own_capitals = letters[ends] - letters[starts], capitals[ends] - capitals[starts]
        mean = sums(lengths) * per_word
        columns += [
            np.log1p(mean), np.log1p(sums(lengths**2) * per_word), distinct * per_word, sums(same) * per_word, sums(seen) * per_word,
            sums(own_letters == 0) * per_word, sums((own_letters > 1) & (own_capitals == own_letters)) * per_word, np.log1p(n_words[of_text]) / 10,
        ]
        features.append(np.stack(columns, 1))
        owners.append(first + of_text)
    if not features:
        return np.zeros((0, FEATURE_COUNT)), np.zeros(0, np.int64)
    return np.concatenate(features), np.concatenate(owners)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(p: dict, x: np.ndarray, begins: np.ndarray):
    """Scores of the bags that begin at ``begins``, and what the gradients need."""
    h = np.tanh(x @ p["W"] + p["b"])
    t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
    e = (t * g) @ p["w"]
    bag = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(x))))
    e = np.exp(e - np.maximum.reduceat(e, begins)[bag])
    a = e / np.add.reduceat(e, begins)[bag]
    z = np.add.reduceat(h * a[:, None], begins)
    return _sigmoid(z @ p["c"] + p["d"]), (h, t, g, a, bag, z)


def _gradients(p: dict, x, begins, y):
    score, (h, t, g, a, bag, z) = _forward(p, x, begins)
    ds = (score - y) / len(y)
    dz = ds[:, None] * p["c"]
    da = (dz[bag] * h).sum(1)
    de = a * (da - np.add.reduceat(a * da, begins)[bag])
    dt, dg = de[:, None] * p["w"] * g * (1 - t**2), de[:, None] * p["w"] * t * g * (1 - g)
    dh = (a[:, None] * dz[bag] + dt @ p["V"].T + dg @ p["U"].T) * (1 - h**2)
    return {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (de[:, None] * t * g).sum(0), "c": z.T @ ds, "d": ds.sum()}


def fit(x: np.ndarray, owner: np.ndarray, y: np.ndarray, seed: int = 5, epochs: int = EPOCHS) -> dict:
    """Network weights from passages ``x`` of bags ``owner`` (sorted, 0 to len(y) - 1) with labels ``y``, by Adam."""
    rng = np.random.default_rng(seed)
    mean, std = x.mean(0), x.std(0) + 1e-6
    x = np.clip((x - mean) / std, -8, 8)
    d = x.shape[1]
    p = {"W": rng.normal(0, d**-0.5, (d, HIDDEN)), "b": np.zeros(HIDDEN), "V": rng.normal(0, HIDDEN**-0.5, (HIDDEN, ATTENTION)),
         "U": rng.normal(0, HIDDEN**-0.5, (HIDDEN, ATTENTION)), "w": rng.normal(0, 0.1, ATTENTION), "c": rng.normal(0, 0.1, HIDDEN), "d": np.array(0.0)}
    m, v, step = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
    bounds = np.searchsorted(owner, np.arange(len(y) + 1))
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(y), BATCH):
            bags = order[k : k + BATCH]
            sizes = bounds[bags + 1] - bounds[bags]
            begins = np.cumsum(sizes) - sizes
            rows = np.repeat(bounds[bags] - begins, sizes) + np.arange(sizes.sum())
            grad, step = _gradients(p, x[rows], begins, y[bags]), step + 1
            for name, g in grad.items():
                g = g + 1e-4 * p[name]
                m[name] = 0.9 * m[name] + 0.1 * g
                v[name] = 0.999 * v[name] + 0.001 * g * g
                rate = RATE * (1 - epoch / epochs)
                p[name] = p[name] - rate * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.999**step)) + 1e-8)
    return p | {"mean": mean, "std": std}


def score(p: dict, x: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0)
    x = np.clip((x - p["mean"]) / p["std"], -8, 8)
    return _forward(p, x, np.searchsorted(owner, np.arange(n)))[0]


def train(docs: DataFrame, labels: DataFrame, allowed, id: str, text: str, label: str, sample: int = SAMPLE):
    """Fitted weights, or the constant score where the labels leave nothing to learn."""
    known = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull() & allowed)
    known = known.groupBy(F.col(id).alias("l_id")).agg(F.min(F.col(label).cast("int")).alias("y"))
    draw = F.pmod(F.xxhash64(F.lit(21), "l_id"), F.lit(1 << 20))
    n = known.count()
    share = int((1 << 20) * min(1.0, sample / max(n, 1))) if n > sample else 1 << 20
    drawn = stored(known.where(draw < share), "label sample")  # about `sample` ids, so the broadcast has a bound

    def run(batches):
        for batch in batches:
            x, owner = passages_of(batch.column(2))
            bags = [x[a:b].ravel().tolist() for a, b in zip(*(lambda t: (t[:-1], t[1:]))(scan.first_of_runs(owner, batch.num_rows)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bags, pa.list_(pa.float64()))], names=["id", "y", "x"])

    rows = docs.select(id, text).join(F.broadcast(drawn), F.col(id) == F.col("l_id")).select(F.col("l_id").alias("id"), "y", text)
    # One text for each id, however many rows repeat it.
    rows = rows.groupBy("id", "y").agg(F.min_by(text, F.xxhash64(text)).alias(text))
    bags = rows.mapInArrow(run, rows.select("id", "y").schema.add("x", T.ArrayType(T.DoubleType()))).toArrow().to_pandas()
    bags = bags.sort_values("id", kind="stable")
    if bags["y"].nunique() < 2:
        return float(bags["y"].iloc[0]) if len(bags) else 1.0
    x = np.concatenate([b.reshape(-1, FEATURE_COUNT) for b in bags["x"]])
    sizes = np.array([len(b) // FEATURE_COUNT for b in bags["x"]])
    return fit(x, np.repeat(np.arange(len(sizes)), sizes), bags["y"].to_numpy(float))


def scored(
    docs: DataFrame, labels: DataFrame, allowed, id: str = "doc_id", text: str = "text", label: str = "quality", keep_text: bool = False,
    column: str = "score",
) -> DataFrame:
    """``docs`` with the score as ``column``: all columns, or the id alone; ``allowed`` says of a label row whether it may be learned from."""
    weights = train(docs, labels, allowed, id, text, label)
    names = [c for c in docs.columns if c != text] + [text] if keep_text else [id, text]
    rows = docs.select(*[quoted(c) for c in names])
    out = names if keep_text else [id]
    if isinstance(weights, float):
        return rows.select(*[quoted(c) for c in out], F.lit(weights).alias(column))

    def run(batches):
        for batch in batches:
            texts, found = batch.column(len(names) - 1), []
            for first in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = texts.slice(first, TEXTS_AT_ONCE)
                found.append(score(weights, *passages_of(part), len(part)))
            result = pa.array(np.concatenate(found or [np.zeros(0)]))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(out)], result], names=[*out, column])

    return rows.mapInArrow(run, rows.select(*[quoted(c) for c in out]).schema.add(column, "double"))


def query(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; labels of held-out rows are never read into the fit."""
    found = scored(documents, labels, ~held_out(F.col("doc_id"), 4, 2))
    predicted = (F.col("score") >= ACCEPTED).cast("int").alias("predicted")
    return found.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", predicted)


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that the classifier rejects."""
    column = unused(docs, "quality_score")
    found = scored(docs, labels, ~held_out(F.col("doc_id"), 4, 2), keep_text=True, column=column)
    return found.where(quoted(column) >= ACCEPTED).select(*all_of(docs))
