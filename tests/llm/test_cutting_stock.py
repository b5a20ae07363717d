import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.llm.conftest import odd_rows
from tradeloom.llm import cutting_stock

WORDS = public_tokenizers.path("word_bpe_49k.json")


def check_packed(docs, rows, size=4096):
    """Each id in one piece, pieces without gaps; returns padded places, tokens and pieces."""
    tokenizer = Tokenizer.from_file(WORDS)
    expected, pieces, sequences = defaultdict(list), defaultdict(list), defaultdict(list)
    for doc in docs.collect():
        ids = tuple([*tokenizer.encode(doc.text or "", add_special_tokens=False).ids, 2])
        expected[doc.doc_id].append(ids)
    for r in rows:
        assert r.length > 0
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(expected)
    for doc_id, texts in expected.items():
        if len(texts) == 1:
            at, ids = 0, np.array(texts[0], "<u4")
            for start, length, crc, total in sorted(pieces[doc_id]):
                assert (start, total) == (at, len(ids))
                assert crc == zlib.crc32(ids[start : start + length].tobytes())
                at += length
            assert at == len(ids)
        else:
            assert sum(length for _, length, _, _ in pieces[doc_id]) == sum(map(len, texts))
    padding = 0
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding, sum(r.length for r in rows), len(rows)


def test_packed_documents_have_no_padding(documents, frame, monkeypatch):
    padding, tokens, pieces = check_packed(documents, cutting_stock.pack(documents, WORDS).collect())
    assert padding == 0 and pieces <= 1.5 * documents.count() + tokens / 4096
    odd = frame(*odd_rows())
    assert check_packed(odd, cutting_stock.pack(odd, WORDS).collect())[0] == 0
    assert cutting_stock.pack(frame(), WORDS).collect() == []
    # Numbered in parts of a few rows each.
    monkeypatch.setattr(cutting_stock, "RANKED", 7)
    many = documents.union(documents.selectExpr("doc_id + 1000000 as doc_id", *documents.columns[1:]))
    assert check_packed(many, cutting_stock.pack(many, WORDS).collect())[0] == 0


def test_few_and_equal_documents(spark):
    for texts in (["a"], ["a b c"] * 5, [None, ""], ["word " * 3000] * 9, ["x " * 4095] * 3, ["y " * 5000]):
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
        assert check_packed(docs, cutting_stock.pack(docs, WORDS).collect())[0] == 0
    rows = [(i, "the very same text" if i % 3 == 0 else f"own {i} " * (i % 50)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    padding, tokens, pieces = check_packed(docs, cutting_stock.pack(docs, WORDS).collect())
    assert padding == 0


def test_most_documents_stay_whole(spark):
    rng = random.Random(6)
    rows = [(i, "w " * min(4000, max(1, int(rng.lognormvariate(5.2, 1.0))))) for i in range(12_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    packed = cutting_stock.pack(docs, WORDS).collect()
    padding, tokens, pieces = check_packed(docs, packed)
    assert padding == 0
    cut = sum(n > 1 for n in Counter(r.doc_id for r in packed).values())
    assert cut <= 0.05 * len(rows)


def test_knapsack_and_program_against_plain_search():
    rng = random.Random(7)
    for _ in range(150):
        sizes = np.array(sorted(rng.sample(range(1, 20), rng.randint(1, 5))))
        values, capacity = np.array([rng.random() for _ in sizes]), rng.randint(20, 40)
        worth, pattern = cutting_stock.knapsack(values, sizes, capacity)
        best = [0.0] * (capacity + 1)
        for t in range(1, capacity + 1):
            best[t] = max([best[t - 1]] + [best[t - s] + v for s, v in zip(sizes.tolist(), values) if s <= t])
        assert abs(worth - best[capacity]) < 1e-9 and pattern @ sizes <= capacity
        demand = np.array([rng.randint(1, 500) for _ in sizes])
        patterns, uses = cutting_stock.solve(demand, sizes, capacity)
        assert (patterns @ sizes <= capacity).all() and (patterns.T @ uses >= demand - 1e-6).all()
        every = all_patterns(sizes.tolist(), capacity)
        assert uses.sum() <= least_by_all_patterns(np.array(every), demand) * 1.001 + 1e-6


def all_patterns(sizes, room):
    if not sizes:
        return [[]]
    return [[n, *rest] for n in range(room // sizes[0] + 1) for rest in all_patterns(sizes[1:], room - n * sizes[0])]


def least_by_all_patterns(patterns, demand):
    """The same program with every pattern listed beforehand."""
    m = len(demand)
    columns = np.diag(patterns.max(axis=0)).astype(float)
    for _ in range(2000):
        inverse = np.linalg.inv(columns)
        used, dual = inverse @ demand, np.ones(m) @ inverse
        worth = patterns @ dual
        if worth.max() <= 1 + 1e-9:
            break
        enters = patterns[int(worth.argmax())].astype(float)
        change = inverse @ enters
        rows = np.flatnonzero(change > 1e-9)
        columns[:, rows[np.argmin(used[rows] / change[rows])]] = enters
    return float(used.sum())


def test_best_fit_places_all():
    sizes = cutting_stock.class_sizes()
    rng = np.random.default_rng(5)
    counts = rng.integers(0, 5, len(sizes))
    patterns = cutting_stock.best_fit(counts, sizes)
    assert (sum(patterns) == counts).all() and all(p @ sizes <= 4096 for p in patterns)
    assert len(patterns) <= 1.1 * (counts @ sizes) / 4096 + 1
