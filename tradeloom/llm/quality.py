"""Quality classifier: heuristic labellers, a label model over their votes, a hashed linear scorer.

Each labeller looks at one trait of a text and votes junk, good or abstains. Expectation-maximisation over
the votes of all documents estimates how often each labeller gives each vote for junk and for good texts
(its accuracies) and how common junk is; that gives a posterior for every pattern of votes. A linear scorer
over hashed shapes of words is trained on these posteriors, on a bounded sample, and decides for all documents.
Its features see more than the labellers' thresholds, so it also decides where those abstain or disagree.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import small_batches, text_of, written

#: Documents the scorer is trained on, those with the smallest hashes; the only thing that is sampled.
TRAINING_DOCUMENTS = 8192
#: Hashed features.
DIMENSIONS = 1024
#: Rejected from this chance of junk on.
REJECT_FROM = 0.5
#: Words whose signs a Python worker keeps.
CACHE_WORDS = 150_000

ABSTAIN, GOOD, JUNK = 0, 1, 2
#: (trait, junk if above, good if below) or, with the signs turned, (trait, junk if below, good if above).
ABOVE = (
    ("noise", 0.25, 0.02),
    ("shouting", 0.5, 0.1),
    ("separators", 0.2, 0.05),
    ("echo", 0.2, 0.03),
    ("commonest", 0.2, 0.12),
    ("word_length", 20.0, 12.0),
)
BELOW = (("variety", 0.2, 0.4), ("letters", 0.88, 0.92), ("endings", 0.004, 0.02))
TRAITS = [t[0] for t in (*ABOVE, *BELOW)]
#: Traits of fewer words than this say too little for a vote.
MIN_WORDS = 12

_RUNS = re.compile(r"(.)\1+", re.DOTALL)
_PLAIN = re.compile(r"[\w.]")


# --- features -------------------------------------------------------------------------------


class ShapeTable(dict):
    """Numbers words; row ``i`` of ``rows`` has the shape and the signs of word ``i``. Kept between texts."""

    def __init__(self):
        super().__init__()
        self.rows = np.zeros((1 << 12, 7), dtype=np.int32)

    def __missing__(self, word: str) -> int:
        at = len(self)
        if at == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[at] = signs(word)
        self[word] = at
        return at

    def numbers(self, words: list[str]) -> np.ndarray:
        if len(self) > CACHE_WORDS:
            self.clear()
            self.rows = np.zeros((1 << 12, 7), dtype=np.int32)
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))


def _mark(c: str) -> str:
    return "a" if c.islower() else "A" if c.isupper() else "w" if c.isalpha() else "0" if c.isdigit() else c


def signs(word: str) -> tuple:
    """Hashed shape, noise, shouting, separator, ending, letters, length.

    The shape writes a for lower case, A for upper case, 0 for digits and other signs as they are, runs once
    (signs and digits with a plus).
    """
    if word.isalpha() and word[1:].islower():
        return _shape("Aa" if word[0].isupper() else "a"), 0, 0, 0, 0, len(word), len(word)
    shape = _RUNS.sub(r"\1+", "".join(map(_mark, word))).replace("a+", "a").replace("A+", "A").replace("w+", "w")
    letters = sum(map(str.isalpha, word))
    noise = _RUNS.search(_PLAIN.sub(" ", word).strip()) is not None
    return (
        _shape(shape),
        noise,
        letters > 1 and word.isupper(),
        letters == 0 and not any(map(str.isdigit, word)),
        word[-1] in ".!?",
        letters,
        len(word),
    )


def _shape(shape: str) -> int:
    return xxhash.xxh32_intdigest(shape.encode("utf-8", "replace")) % DIMENSIONS


_table = ShapeTable()


def describe(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Traits in the order of ``TRAITS``, and the hashed features: roots of the shares of shapes."""
    words = text.split()
    if not words:
        return np.full(len(TRAITS), np.nan), np.zeros(DIMENSIONS, dtype=np.float32)
    numbers, n = _table.numbers(words), len(words)
    rows = _table.rows[numbers]
    sums = rows.sum(axis=0, dtype=np.int64)
    noise, shouting, separators, endings = sums[1:5] / n
    echo = int((numbers[1:] == numbers[:-1]).sum()) / n
    # Variety of long texts falls by itself; a thousand words at a time are compared.
    variety = float(np.mean([len(set(words[i : i + 1000])) / len(words[i : i + 1000]) for i in range(0, n, 1000)]))
    commonest = max(Counter(words).values()) / n
    length, letters = sums[6] / n, sums[5] / sums[6]
    traits = np.array([noise, shouting, separators, echo, commonest, length, variety, letters, endings])
    if n < MIN_WORDS:
        traits[:] = np.nan
    counts = np.bincount(rows[:, 0], minlength=DIMENSIONS).astype(np.float32)
    counts[_shape("echo")] += echo * n
    counts[_shape("monotony")] += (1 - variety) * n
    return traits, np.sqrt(counts / n)


def votes(traits: np.ndarray) -> list[int]:
    """A vote per labeller; traits that are not known abstain."""
    found = []
    for value, (_, junk, good) in zip(traits, ABOVE):
        found.append(JUNK if value > junk else GOOD if value < good else ABSTAIN)
    for value, (_, junk, good) in zip(traits[len(ABOVE) :], BELOW):
        found.append(JUNK if value < junk else GOOD if value > good else ABSTAIN)
    return found


def pattern_of(vote: list[int]) -> int:
    return sum(v * 3**i for i, v in enumerate(vote))


def votes_of(pattern: int) -> list[int]:
    return [pattern // 3**i % 3 for i in range(len(TRAITS))]


# --- the label model ------------------------------------------------------------------------


def label_model(patterns: dict[int, int], rounds: int = 200) -> tuple[dict[int, float], np.ndarray, float]:
    """Posterior of junk per pattern of votes, accuracies (labeller, class, vote), share of junk.

    ``patterns``: documents per pattern, at most 3^9. The first guess is junk wherever any labeller says so.
    An abstention says nothing. The prior, a twentieth of the weight, is that a labeller sees three of ten
    junk texts, those of its kind, and speaks against one of a hundred good ones.
    """
    keys = sorted(patterns)
    weights = np.array([patterns[k] for k in keys], dtype=float)
    table = np.array([votes_of(k) for k in keys]).reshape(len(keys), len(TRAITS))
    chosen = np.stack([table == GOOD, table == JUNK], axis=2).astype(float)
    posterior = np.where((table == JUNK).any(axis=1), 0.9, 0.05)
    prior = np.array([[0.99, 0.01], [0.7, 0.3]])
    accuracies, share = np.tile(prior, (len(TRAITS), 1, 1)), 0.1
    for _ in range(rounds if keys else 0):
        mass = np.stack([weights * (1 - posterior), weights * posterior])
        counts = np.einsum("cp,plv->lcv", mass, chosen)
        counts += prior * (0.05 * mass.sum(axis=1)[None, :, None] + 1)
        accuracies = counts / counts.sum(axis=2, keepdims=True)
        share = (mass[1].sum() + 1) / (weights.sum() + 10)
        logs = np.einsum("plv,lcv->pc", chosen, np.log(accuracies)) + np.log([1 - share, share])
        new = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -500, 500)))
        if np.abs(new - posterior).max() < 1e-7:
            break
        posterior = new
    return dict(zip(keys, posterior.tolist())), accuracies, float(share)


# --- the scorer -----------------------------------------------------------------------------


def train(features: np.ndarray, junk: np.ndarray, steps: int = 400, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model on soft labels, by gradient descent with momentum."""
    weights, bias = np.zeros(features.shape[1], dtype=np.float32), np.float32(0)
    if not len(features):
        return weights, 0.0
    junk, rate = junk.astype(np.float32), np.float32(2.0)
    speed, bias_speed = np.zeros_like(weights), np.float32(0)
    across = np.ascontiguousarray(features.T)
    for _ in range(steps):
        error = (1 / (1 + np.exp(-(features @ weights + bias))) - junk) / np.float32(len(features))
        speed = np.float32(0.9) * speed - rate * (across @ error + np.float32(decay) * weights)
        bias_speed = np.float32(0.9) * bias_speed - rate * error.sum()
        weights, bias = weights + speed, bias + bias_speed
    return weights, float(bias)


def _pack(features: np.ndarray) -> bytes:
    used = np.flatnonzero(features)
    return used.astype(np.uint16).tobytes() + features[used].astype(np.float32).tobytes()


def _unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(packed) // 6
    return np.frombuffer(packed, np.uint16, n), np.frombuffer(packed, np.float32, n, offset=2 * n)


def _described(batches):
    for batch in small_batches(batches):
        pairs = [describe(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                batch.column("digest"),
                pa.array([pattern_of(votes(t)) for t, _ in pairs], pa.int32()),
                pa.array([_pack(f) for _, f in pairs], pa.binary()),
            ],
            names=["id", "digest", "pattern", "features"],
        )


class Classifier:
    """The trained model; small, and sent to all tasks."""

    def __init__(self, posteriors: dict[int, float], accuracies: np.ndarray, weights: np.ndarray, bias: float):
        self.posteriors, self.accuracies, self.weights, self.bias = posteriors, accuracies, weights, bias

    def junk(self, packed: bytes) -> float:
        """Chance of junk; a text without words is not called junk."""
        places, values = _unpack(packed)
        if not len(places):
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(values @ self.weights[places] + self.bias, -500, 500))))


def fit(described: DataFrame, training_documents: int = TRAINING_DOCUMENTS) -> Classifier:
    """From rows as ``describe_documents`` makes them: label model on all of them, scorer on a bounded sample.

    Copies of a text under different ids are drawn one by one; only rows of one id and text are drawn together.
    """
    counted = described.groupBy("pattern").agg(F.count("*").alias("n")).collect()
    posteriors, accuracies, _ = label_model({r.pattern: r.n for r in counted})
    sample = (
        described.filter(F.length("features") > 0)
        .sort(F.xxhash64("id", "digest"), "pattern", "features")
        .limit(training_documents)
        .select("pattern", "features")
        .collect()
    )
    features = np.zeros((len(sample), DIMENSIONS), dtype=np.float32)
    for i, row in enumerate(sample):
        places, values = _unpack(bytes(row.features))
        features[i, places] = values
    weights, bias = train(features, np.array([posteriors[r.pattern] for r in sample]))
    return Classifier(posteriors, accuracies, weights, bias)


def describe_documents(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = text_of(text_column)
    source = docs.select(F.col(id_column).alias("id"), text.alias("text"), F.xxhash64(text).alias("digest"))
    id_type = source.schema["id"].dataType.simpleString()
    return written(
        source.mapInArrow(_described, f"id {id_type}, digest bigint, pattern int, features binary"), "quality"
    )


def classify(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    training_documents: int = TRAINING_DOCUMENTS,
) -> DataFrame:
    """Per row: id, pattern (votes as digits of base 3), label_junk (label model), junk (scorer), kept.

    The scorer decides. Texts of fewer than 12 words get no votes but are scored; texts without words, null
    ones among them, are kept. Repeated rows count as often as they come. An empty table gives no rows.
    """
    described = describe_documents(docs, id_column, text_column)
    model = docs.sparkSession.sparkContext.broadcast(fit(described, training_documents))

    def run(batches):
        for batch in batches:
            patterns = batch.column("pattern").to_pylist()
            junk = [model.value.junk(f) for f in batch.column("features").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("pattern"),
                    pa.array([model.value.posteriors[p] for p in patterns], pa.float64()),
                    pa.array(junk, pa.float64()),
                    pa.array([j < REJECT_FROM for j in junk], pa.bool_()),
                ],
                names=["id", "pattern", "label_junk", "junk", "kept"],
            )

    id_type = described.schema["id"].dataType.simpleString()
    return described.mapInArrow(
        run, f"id {id_type}, pattern int, label_junk double, junk double, kept boolean"
    ).withColumnRenamed("id", id_column)


def keep_good(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with all their columns.

    The decision depends on the text alone, so the rows are filtered where they are read.
    """
    described = describe_documents(docs, id_column, text_column)
    model = docs.sparkSession.sparkContext.broadcast(fit(described))
    place = docs.columns.index(text_column)

    def run(batches):
        for batch in batches:
            texts = batch.column(place).to_pylist()
            junk = [model.value.junk(_pack(describe(str(t if t is not None else ""))[1])) for t in texts]
            yield batch.filter(pa.array([j < REJECT_FROM for j in junk], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
