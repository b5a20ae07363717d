import hashlib
import random
import zlib

from tests.llm.conftest import odd_rows
from tradeloom.llm import periodic_runs, queries


def plain_runs(words, least=12):
    """Every period, every stretch."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            stretch = words[start : i + q]
            if i > start and len(stretch) >= max(least, 2 * q):
                if not any(stretch[r:] == stretch[:-r] for r in range(1, q)):
                    found.append((start, q, i + q - start))
            i = max(i, start + 1)
    return sorted(found)


def planted(doc_id, words):
    h = zlib.crc32(str("" if doc_id is None else doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text, rewrite=planted):
    words = rewrite(doc_id, (text or "").encode().split())
    runs = plain_runs(words)
    dropped = {i for s, q, n in runs for i in range(s + q, s + n)}
    collapsed = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    best = min(runs, key=lambda r: (-r[2], r[0], r[1]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, q, n in runs)
    four = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    digests = hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest()
    return (doc_id, len(runs), *four, *digests)


COLUMNS = "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[-2:]))


def test_documents_with_planted_periods(documents, frame):
    odd = [(i, t, s) for i, t, s in odd_rows() if len(t or "") < 100_000]
    few = documents.filter("length(text) < 4000")
    for docs in (few, frame(*odd)):
        got = periodic_runs.periodic_runs(docs, queries.with_planted_period).select("doc_id", *COLUMNS)
        assert ordered(got.collect()) == ordered(expected(r.doc_id, r.text) for r in docs.collect())
    assert periodic_runs.periodic_runs(frame()).collect() == []


def random_documents(n, longest=160):
    rng = random.Random(3)
    for i in range(n):
        kinds, size = rng.choice([1, 2, 2, 3, 5, 50]), rng.choice([0, 1, 11, 12, 13, 24, 40, 90, longest])
        words = [str(rng.randint(1, kinds)) for _ in range(size)]
        if size and rng.random() < 0.6:
            a, p = rng.randrange(size), rng.randint(1, max(1, size // 2))
            words = [words[j] if j < a else words[a + (j - a) % p] for j in range(size)]
        if size > 3 and rng.random() < 0.3:
            words[rng.randrange(size)] = "x"
        yield i, " ".join(words)


def test_random_words_against_every_period(spark, monkeypatch):
    rows = list(random_documents(1200))
    for tiles_of in (16, 1):
        monkeypatch.setattr(periodic_runs, "BOUNDARIES", tiles_of)
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
        got = periodic_runs.periodic_runs(docs, texts=True)
        assert ordered(got.select("doc_id", *COLUMNS).collect()) == ordered(
            expected(i, t, lambda _, words: words) for i, t in rows
        )
    for row in got.collect():
        assert hashlib.sha256(row.collapsed.encode()).hexdigest() == row.collapsed_sha256
        assert [r.start for r in row.runs] == sorted(r.start for r in row.runs)


def test_long_documents(spark):
    rng = random.Random(4)
    block = [str(rng.randint(1, 10**6)) for _ in range(5000)]
    other = [str(rng.randint(1, 10**6)) for _ in range(7000)]
    rows = [
        (1, " ".join(["same"] * 30_000)),
        (2, " ".join(other + block * 8)),
        (3, " ".join((["a", "b", "c"] * 20 + ["d"]) * 300)),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in periodic_runs.periodic_runs(docs).collect()}
    assert (got[1].n_runs, got[1].start, got[1].length, got[1].period) == (1, 0, 30_000, 1)
    assert (got[2].n_runs, got[2].start, got[2].length, got[2].period) == (1, 7000, 40_000, 5000)
    assert got[2].collapsed_sha256 == hashlib.sha256(" ".join(other + block).encode()).hexdigest()
    # One run of the whole and one of three words in each of its blocks.
    assert got[3].n_runs == 301 and (got[3].length, got[3].period) == (300 * 61, 61)


def test_repeated_rows_and_other_least_lengths(spark):
    text = "a b a b a b a b x"
    docs = spark.createDataFrame([(1, text), (1, text), (None, text)], "doc_id bigint, text string")
    for least, n in ((12, 0), (8, 1), (4, 1), (1, 1)):
        rows = periodic_runs.periodic_runs(docs, least=least).collect()
        assert [r.n_runs for r in rows] == [n] * 3
        assert not n or all((r.start, r.length, r.period) == (0, 8, 2) for r in rows)
