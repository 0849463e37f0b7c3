"""Toxicity: gradient-boosted trees over dense text features, calibrated by isotonic regression.

One scan of the texts gives every document a short row of numbers: densities of insults (a fixed list, and words that the
training labels show), how often a hit stands near a second person, capitals, punctuation, and obfuscated spellings. Trees
and calibration are fitted by Spark ML on a sample of the labelled rows whose expected size ``SAMPLE`` is a parameter; words
and trees learn from three quarters of it, the calibration from the rest. Labels, language, source and id are no inputs.

Null and empty texts are scored from their (all zero) features like any other. Without labelled rows every score is 0; with
rows of one label only it is that label. Several labels of one id count as toxic if any of them is 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.llm import scan
from shoptrail.runtime import stored

#: Expected number of labelled rows to fit on, and of words learned from them.
SAMPLE, LEARNED_WORDS = 20_000, 200
#: Words to either side in which a second person counts as near.
NEAR = 5

#: Common insults, and second-person words of English, German, French and Spanish.
INSULTS = (
    "idiot idiots moron morons imbecile stupid dumb dumbass fool loser losers scum trash garbage filth vermin worthless useless "
    "pathetic disgusting clown pig swine bastard bitch asshole jerk creep freak retard cretin dimwit halfwit parasite maggot "
    "hate kill die ugly shit crap damn fuck fucking idiota estupido basura imbecil idioten dumm dreck abschaum connard imbecile"
).split()
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch tu toi te ton ta vous votre tus ti usted ustedes vos".split()
#: Digits and signs that stand for letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

FEATURES = [
    "insults", "insult_count", "insults_near_you", "learned", "learned_count", "hidden", "you", "capitals", "shouted", "punctuation",
    "exclamations", "obfuscated", "words",
]

_B = np.arange(256)
_UPPER = (_B >= 0x41) & (_B <= 0x5A)
_LETTER = _UPPER | ((_B >= 0x61) & (_B <= 0x7A)) | (_B >= 0x80)
_DIGIT = (_B >= 0x30) & (_B <= 0x39)
_PUNCTUATION = (_B > 0x20) & (_B < 0x7F) & ~_LETTER & ~_DIGIT
_LOOKALIKE = np.array([ord(LOOKALIKES.get(chr(b), chr(b))) if b < 0x80 else b for b in scan.LOWER], np.uint8)
_OBFUSCATED = scan.ALNUM | np.isin(_B, [ord("@"), ord("$")]) | _UPPER


def hashes_of(words) -> np.ndarray:
    """Sorted hashes of words, as ``scan.word_hashes`` gives them."""
    raw = [w.encode() for w in words if w]
    ends = np.cumsum([len(w) for w in raw], dtype=np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    return np.unique(scan.word_hashes(data, ends - [len(w) for w in raw], ends)) if raw else np.empty(0, np.uint64)


def _among(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(hashes), bool)
    return table[np.minimum(np.searchsorted(table, hashes), len(table) - 1)] == hashes


def features_of(column: pa.Array, insults: np.ndarray, persons: np.ndarray, learned: np.ndarray) -> np.ndarray:
    out = np.zeros((len(column), len(FEATURES)))
    for first, raw, off in scan.chunks(column):
        data, n = scan.LOWER[raw], len(off) - 1
        starts, ends, owner = scan.words(data, off, scan.ALNUM)
        n_words = np.bincount(owner, minlength=n)
        per_word = 1 / np.maximum(n_words, 1)
        hashes = scan.word_hashes(data, starts, ends)
        insult, you, shown = (_among(hashes, table) for table in (insults, persons, learned))
        # Insults in a text with a second person at most NEAR words away.
        reach = np.concatenate([[0], np.cumsum(you)])
        bounds = scan.first_of_runs(owner, n)
        at = np.flatnonzero(insult | shown)
        low, high = np.maximum(at - NEAR, bounds[owner[at]]), np.minimum(at + NEAR + 1, bounds[owner[at] + 1])
        near = reach[high] > reach[low]
        # Words that are insults only once signs and digits are read as letters.
        o_starts, o_ends, o_owner = scan.words(raw, off, _OBFUSCATED)
        plain = _LOOKALIKE[raw]
        changed = np.concatenate([[0], np.cumsum(plain != data)])
        odd = changed[o_ends] > changed[o_starts]
        o_starts, o_ends, o_owner = o_starts[odd], o_ends[odd], o_owner[odd]
        letters = np.concatenate([[0], np.cumsum(_LETTER[raw])])
        mixed = letters[o_ends] > letters[o_starts]
        hidden = _among(scan.word_hashes(plain, o_starts, o_ends), insults)
        counts = {name: np.concatenate([[0], np.cumsum(table[raw])]) for name, table in
                  (("upper", _UPPER), ("letter", _LETTER), ("punctuation", _PUNCTUATION), ("exclamation", _B == 0x21))}
        total = {name: c[off[1:]] - c[off[:-1]] for name, c in counts.items()}
        shouted = (ends - starts > 2) & (counts["upper"][ends] - counts["upper"][starts] == ends - starts)
        count = lambda which: np.bincount(which, minlength=n)
        size = np.maximum(np.diff(off), 1)
        n_insults, n_learned = count(owner[insult]), count(owner[shown])
        columns = [
            n_insults * per_word, np.log1p(n_insults), count(owner[at[near]]) * per_word, n_learned * per_word, np.log1p(n_learned),
            count(o_owner[hidden]) * per_word, count(owner[you]) * per_word, total["upper"] / np.maximum(total["letter"], 1),
            count(owner[shouted]) * per_word, total["punctuation"] / size, total["exclamation"] / size,
            count(o_owner[mixed]) * per_word, np.log1p(n_words),
        ]
        out[first : first + n] = np.stack(columns, 1)
    return out


def features(docs: DataFrame, learned: list[str], id: str = "doc_id", text: str = "text") -> DataFrame:
    """The id and the feature columns of every row of ``docs``."""
    tables = hashes_of(INSULTS), hashes_of(SECOND_PERSON), hashes_of(learned)
    lean = docs.select(id, text)

    def run(batches):
        for batch in batches:
            values = features_of(batch.column(1), *tables)
            columns = [pa.array(np.ascontiguousarray(values[:, k])) for k in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[id, *FEATURES])

    schema = docs.select(id).schema
    for name in FEATURES:
        schema = schema.add(name, "double")
    return lean.mapInArrow(run, schema)


def sample_of_labels(labels: DataFrame, id: str, label: str, train, sample: int) -> DataFrame:
    """``(id, y, part)`` of about ``sample`` labelled ids that may be learned from; part 0 to 3 is as good as random."""
    known = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull() & train)
    known = known.groupBy(F.col(id).alias("l_id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    draw = F.pmod(F.xxhash64(F.lit(11), "l_id"), F.lit(1 << 20))
    n = known.count()
    drawn = known.where(draw < int((1 << 20) * min(1.0, sample / max(n, 1))) + (n <= sample) * (1 << 20))
    return stored(drawn.withColumn("part", F.pmod(F.xxhash64(F.lit(12), "l_id"), F.lit(4))), "label sample")


def learned_words(docs: DataFrame, sample: DataFrame, id: str, text: str, most: int = LEARNED_WORDS) -> list[str]:
    """Up to ``most`` words that stand in toxic training texts far more often than in others."""
    n = dict(sample.where("part > 0").groupBy("y").count().collect())
    if not n.get(1) or not n.get(0):
        return []
    # At most about SAMPLE ids, so the broadcast has a bound.
    texts = docs.select(id, text).join(F.broadcast(sample.where("part > 0")), F.col(id) == F.col("l_id"))
    words = F.array_distinct(F.split(F.lower(F.col(text)), "[^a-z0-9\\x{80}-\\x{10FFFF}]+"))
    counts = texts.select("y", F.explode(words).alias("word")).where("length(word) > 1")
    counts = counts.groupBy("word").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
    lift = F.log(((F.col("a") + 0.5) / (n[1] + 1)) / ((F.col("b") + 0.5) / (n[0] + 1)))
    shown = counts.where(F.col("a") >= max(3, n[1] // 50)).withColumn("lift", lift).where("lift > 2")
    return [r[0] for r in shown.orderBy((F.col("a") * F.col("lift")).desc(), "word").limit(most).select("word").collect()]


def scores(
    docs: DataFrame, labels: DataFrame, train, id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE
) -> DataFrame:
    """Every row of ``docs`` with id and ``score``; ``train`` says of a row of ``labels`` whether it may be learned from."""
    drawn = sample_of_labels(labels, id, label, train, sample)
    classes = {r[0] for r in drawn.select("y").distinct().collect()}
    if len(classes) < 2:
        return docs.select(id, F.lit(float(max(classes, default=0))).alias("score"))
    rows = stored(features(docs, learned_words(docs, drawn, id, text), id, text), "features")
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(rows)
    fold = stored(rows.join(F.broadcast(drawn), F.col(id) == F.col("l_id")), "training rows")
    fold = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(fold).withColumn("y", F.col("y").cast("double"))
    trees = GBTClassifier(featuresCol="x", labelCol="y", maxDepth=4, maxIter=20, stepSize=0.2, seed=7, cacheNodeIds=False)
    trees = trees.fit(fold.where("part > 0").select("x", "y"))
    margin = lambda df: trees.transform(df).withColumn("margin", vector_to_array("rawPrediction")[1])
    # One row of each label far outside keeps the calibration defined on a few rows; their weight is one row's.
    calibration = margin(fold.where("part = 0")).select("margin", "y", F.lit(1.0).alias("w"))
    ends = docs.sparkSession.range(1).select(F.inline(F.array(*[F.struct(F.lit(m).alias("margin"), F.lit(y).alias("y"), F.lit(1.0).alias("w")) for m, y in ((-4.0, 0.0), (4.0, 1.0))])))
    curve = IsotonicRegression(featuresCol="margin", labelCol="y", weightCol="w", predictionCol="score").fit(calibration.union(ends))
    scored = curve.transform(margin(assembled).select(id, "margin"))
    return scored.select(id, F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score"))


def held_out(id, parts: int, part: int):
    """Whether crc32 of the id as text falls in ``part``; a null id does not."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % parts == part, F.lit(False))


def query(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; labels of held-out rows are never read into the fit."""
    found = scores(documents, labels, ~held_out(F.col("doc_id"), 5, 0))
    return found.select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
