"""Secret scan: fixed patterns, and a battery of randomness tests with false-discovery control.

Candidates of the battery are long unbroken runs of letters, digits and the signs of the usual encodings.
A run is cut at inner equals signs, and a part that no alphabet holds at the signs that break its encoding.
The smallest alphabet that holds a part's characters is its inferred encoding. Under the hypothesis that
the characters are independent and uniform over it, three tests are made: chi-squared for the alphabet's
uniformity, runs above and below the alphabet's middle, and lag-one serial correlation. A run that fails
the combined tests is text. Passing proves little for a short run, so the second hypothesis, that a run is ordinary text,
is tested as well: the ratio of its probability as random characters to that under the corpus's own
character pairs has mean at most one for text, so one over it bounds a p-value, and it falls with the length
by itself. The Benjamini-Hochberg step over all candidates of the corpus then sets the level at which
runs are reported.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import small_batches, text_of, written

#: The order of kinds at equal starts.
KINDS = ("assign", "access", "hex", "random")
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX, MIN_RANDOM = 8, 16, 32, 20
#: A run is taken for random only if its combined tests do not reject that at this level ...
BATTERY_LEVEL = 1e-3
#: ... and the expected share of ordinary text among the reported runs is at most this.
FALSE_DISCOVERY_RATE = 0.01
#: Steps of log10 p in which candidates are counted for the corpus-wide level.
P_STEP, P_STEPS = 0.05, 4000

_ASSIGN = re.compile(
    r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
#: Parts of a run, with the filling at its end; and what is left of a part that mixes the signs of two encodings.
_PART = re.compile(r"[^=]+(?:=+\Z)?")
_PURE = tuple(re.compile(rf"[^{signs}]+") for signs in ("_-", "+/", "+/_-"))

# Alphabets from the smallest to the largest.
ENCODINGS = {
    "decimal": "0123456789",
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "BASE36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
_PLACES = {name: {c: i for i, c in enumerate(letters)} for name, letters in ENCODINGS.items()}


# --- fixed patterns -------------------------------------------------------------------------


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end) of the fixed patterns, in order."""
    spans, low = [], text.lower()
    # Looking for plain words first is many times faster than the pattern, and lower() finds more than it does.
    if any(word in low for word in _ASSIGN_WORDS):
        spans = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= MIN_ASSIGNED]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


def written_spans(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


# --- the battery ----------------------------------------------------------------------------


def encoding(run: str) -> str | None:
    """The smallest alphabet that holds all characters, without the filling at the end."""
    letters = set(run.rstrip("="))
    return next((name for name, places in _PLACES.items() if letters and letters <= places.keys()), None)


def parts(run: str) -> list[tuple[int, int]]:
    """(start, end) of what is tested of a run: long parts that an alphabet holds; those of one mixed part may overlap."""
    found = set()
    for part in _PART.finditer(run):
        pure = [part] if encoding(part[0]) else [m for cut in _PURE for m in cut.finditer(run, *part.span())]
        found.update(m.span() for m in pure if len(m[0].rstrip("=")) >= MIN_RANDOM)
    return sorted(found)


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _upper_chi(x: float, df: float) -> float:
    """Chance of a chi-squared value above x, by the cube-root normal approximation."""
    if x <= 0:
        return 1.0
    z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


def uniformity(places: list[int], size: int) -> float:
    """Chi-squared test that all characters of the alphabet are equally likely."""
    expected = len(places) / size
    counts = np.bincount(places, minlength=size)
    return _upper_chi(float(((counts - expected) ** 2).sum() / expected), size - 1)


def runs_test(places: list[int], size: int) -> float:
    """Number of runs above and below the middle of the alphabet."""
    high = [p * 2 >= size for p in places]
    n, ones = len(high), sum(high)
    zeros = n - ones
    if not ones or not zeros:
        return 2.0 ** (1 - n)
    runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
    mean = 2 * ones * zeros / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    return _two_sided((runs - mean) / math.sqrt(variance)) if variance > 0 else 1.0


def serial_correlation(places: list[int]) -> float:
    """Correlation of each character's place with the next one's."""
    x = np.array(places, dtype=float)
    x -= x.mean()
    spread = float((x * x).sum())
    if spread == 0:
        return 0.0
    return _two_sided(float((x[:-1] * x[1:]).sum()) / spread * math.sqrt(len(places)))


def battery(run: str, name: str) -> float:
    """Fisher's combination of the three tests: small if the run does not look random."""
    places = [_PLACES[name][c] for c in run.rstrip("=")]
    size = len(ENCODINGS[name])
    tests = (uniformity(places, size), runs_test(places, size), serial_correlation(places))
    half = -sum(math.log(max(p, 1e-300)) for p in tests)
    return math.exp(-half) * (1 + half + half * half / 2)


def text_evidence(run: str, name: str, log_pairs: np.ndarray) -> float:
    """log10 of a bound on the chance that ordinary text looks this random, at most 0."""
    codes = np.frombuffer((" " + run.rstrip("=")).encode("ascii"), dtype=np.uint8)
    as_text = float(log_pairs[codes[:-1], codes[1:]].sum())
    as_random = -(len(codes) - 1) * math.log10(len(ENCODINGS[name]))
    return min(0.0, as_text - as_random)


def _pair_counts(batches):
    total, size = np.zeros(1 << 14, dtype=np.int64), 0
    for batch in small_batches(batches):
        # Only ASCII matters for runs; every other byte, and every long run, breaks the chain as a blank.
        text = _RUN.sub(" ", "\n".join(batch.column("text").to_pylist()))
        codes = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
        codes = np.where((codes > 126) | (codes < 33), 32, codes).astype(np.int32)
        if len(codes) > 1:
            total += np.bincount(codes[:-1] << 7 | codes[1:], minlength=1 << 14)
        size += len(codes)
    if size:
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["pair", "n"])


def log_pairs(texts: DataFrame) -> np.ndarray:
    """log10 of the chance of a character after another in the corpus outside long runs; 128 x 128."""
    counts = np.full(1 << 14, 0.5)
    # At most 2^14 rows, whatever the corpus.
    pairs = texts.mapInArrow(_pair_counts, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    for row in pairs.collect():
        counts[row.pair] += row.n
    counts = counts.reshape(128, 128)
    return np.log10(counts / counts.sum(axis=1, keepdims=True))


# --- the operator ---------------------------------------------------------------------------


def candidates(
    matches: list[re.Match], base: list[tuple[int, int, int]], pairs: np.ndarray
) -> tuple[int, list[tuple[int, int, float]]]:
    """Tests made, and (start, end, log10 p) of the parts of long runs that pass the battery and touch no base span.

    Of overlapping parts, which are other readings of the same characters, the one of the least p is taken.
    """
    tests, found = 0, []
    for match in matches:
        tested, passed = parts(match[0]), []
        # A run without a part to test counts as well, which only makes the level stricter.
        tests += max(len(tested), 1)
        for a, b in tested:
            start, end, run = match.start() + a, match.start() + b, match[0][a:b]
            if any(first < end and start < last for first, _, last in base):
                continue
            name = encoding(run)
            evidence = text_evidence(run, name, pairs)
            if evidence < 0 and battery(run, name) >= BATTERY_LEVEL:
                passed.append((evidence, start, end))
        taken = []
        for evidence, start, end in sorted(passed):
            if all(end <= first or last <= start for first, last, _ in taken):
                taken.append((start, end, evidence))
        found += sorted(taken)
    return tests, found


def _scan(pairs: np.ndarray):
    def run(batches):
        for batch in small_batches(batches):
            texts = batch.column("text").to_pylist()
            base = [base_spans(t) for t in texts]
            matches = [list(_RUN.finditer(t)) for t in texts]
            tested = [candidates(m, b, pairs) for m, b in zip(matches, base)]
            runs, extra = [n for n, _ in tested], [found for _, found in tested]
            kinds = [[s[1] for s in b] for b in base]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    *[pa.array([k.count(i) for k in kinds], pa.int64()) for i in range(3)],
                    pa.array([written_spans(b) for b in base], pa.string()),
                    pa.array(runs, pa.int64()),
                    pa.array([[{"start": a, "end": b, "p": p} for a, b, p in e] for e in extra], _CANDIDATES),
                ],
                names=["id", "n_assign", "n_access", "n_hex", "base", "runs", "candidates"],
            )

    return run


_CANDIDATES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))


def discovery_level(scanned: DataFrame, rate: float = FALSE_DISCOVERY_RATE) -> float:
    """The largest log10 p at which Benjamini and Hochberg report a run; -inf if none.

    All long runs of the corpus, or the parts tested of them, count as tests. P-values are rounded up to steps, which only makes the
    level stricter; so the counts of at most 4,000 steps decide.
    """
    tests = scanned.agg(F.sum("runs")).first()[0] or 0
    step = F.least(F.floor(-F.col("c.p") / P_STEP), F.lit(P_STEPS)).cast("int")
    rows = scanned.select(F.explode("candidates").alias("c")).groupBy(step.alias("step")).agg(F.count("*").alias("n"))
    counts = np.zeros(P_STEPS + 1)
    for row in rows.collect():
        counts[row.step] = row.n
    at_least = counts[::-1].cumsum()[::-1]
    for step in range(P_STEPS + 1):
        if at_least[step] and -step * P_STEP <= math.log10(rate * at_least[step] / max(tests, 1)):
            return -step * P_STEP
    return -math.inf


def _finish(level: float):
    def run(batches):
        for batch in batches:
            base = batch.column("base").to_pylist()
            spans = []
            for text, extra in zip(base, batch.column("candidates").to_pylist()):
                parts = [x.split(":") for x in text.split(",") if x]
                all_spans = [(int(start), KINDS.index(kind), int(end)) for kind, start, end in parts]
                all_spans += [(c["start"], 3, c["end"]) for c in extra if c["p"] <= level]
                spans.append(written_spans(all_spans))
            kept = batch.select(["id", "n_assign", "n_access", "n_hex"])
            digests = [hashlib.sha256(b.encode()).hexdigest() for b in base]
            kept = kept.append_column("base_sha256", pa.array(digests, pa.string()))
            yield kept.append_column("spans", pa.array(spans, pa.string()))

    return run


def find_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end, code points, comma-joined).

    The base kinds are fixed patterns; ``random`` spans come from the battery and never touch a base span.
    Null and empty texts have no spans. Repeated rows count as tests of their own. A text is scanned whole. An
    empty table gives no rows.
    """
    source = docs.select(F.col(id_column).alias("id"), text_of(text_column).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    pairs = docs.sparkSession.sparkContext.broadcast(log_pairs(source.select("text")))

    def scan(batches):
        return _scan(pairs.value)(batches)

    columns = f"id {id_type}, n_assign bigint, n_access bigint, n_hex bigint"
    found = "base string, runs bigint, candidates array<struct<start: bigint, end: bigint, p: double>>"
    scanned = written(source.mapInArrow(scan, f"{columns}, {found}"), "secrets")
    level = discovery_level(scanned)
    return scanned.mapInArrow(_finish(level), f"{columns}, base_sha256 string, spans string").withColumnRenamed(
        "id", id_column
    )
