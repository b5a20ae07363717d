import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import SF_DIR, odd_rows
from tradeloom.llm import quality, suffix_tree


def plain_base(rows):
    """id, held_out, n_tokens, n_known, train_tokens, base_score by the definition."""
    counts, split = Counter(), []
    for id_, text in rows:
        words = (text or "").encode().lower().split() + [b"\n"]
        held = zlib.crc32(str("" if id_ is None else id_).encode()) % 10 == 0
        split.append((id_, held, words))
        if not held:
            counts.update(words)
    total, distinct = sum(counts.values()), len(counts)
    for id_, held, words in split:
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in words)
        yield id_, held, len(words), sum(counts[w] > 0 for w in words), total, base


def key(row):
    return (row[0] is None, row[0] or 0, *row[1:4])


def check(docs, got):
    expected = sorted(plain_base([(r.doc_id, r.text) for r in docs.collect()]), key=key)
    got = sorted(
        ((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key
    )
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    assert [g[5] for g in got] == pytest.approx([e[5] for e in expected])


def test_scores_of_documents(documents):
    got = suffix_tree.score(documents).collect()
    check(documents, got)
    held = [r for r in got if r.held_out]
    assert held and sum(r.score for r in held) > 0.9 * sum(r.base_score for r in held)
    assert all(r.score <= 0 for r in got)


def test_scores_of_odd_rows(frame):
    docs = frame(*odd_rows())
    got = suffix_tree.score(docs).collect()
    check(docs, got)
    assert suffix_tree.score(frame()).count() == 0
    lone = suffix_tree.score(frame((None, "nothing to learn from"))).collect()
    assert [(r.train_tokens, r.score) for r in lone] == [(0, 0.0)]


def test_distributions_add_up_and_longest_context_wins(spark, frame):
    """Over all kept words and the class of the others, each context's predictions sum to one."""
    texts = ["a b c", "a b c", "x b d", "x b d", "q a b c d", "x b d a", "e f", "e g"] * 6
    rows = frame(*[(i, t) for i, t in enumerate(texts)]).selectExpr("doc_id AS id", "text")
    tree, _ = suffix_tree.train(rows)
    assert len(tree.levels) == 2 and all(level.retained.any() for level in tree.levels)
    symbols = np.append(np.arange(len(tree.words)), suffix_tree.RARE)
    for one in range(-1, len(tree.levels[0].contexts)):
        for two in range(-1, len(tree.levels[1].contexts)):
            if two >= 0 and tree.levels[1].contexts[two] % suffix_tree._width(tree) != one:
                continue
            places = [np.full(len(symbols), one), np.full(len(symbols), two)]
            p = suffix_tree.predict(tree, symbols, places)
            p[-1] *= tree.rare_mass()
            assert p.sum() == pytest.approx(1)
    # b is followed by c after a, by d after x: only the longer context tells.
    def chance(text, at):
        words = suffix_tree.tokens(text)
        symbols = tree.symbols(words)
        return suffix_tree.predict(tree, symbols, suffix_tree.context_places(tree, symbols, np.array([0])))[at]

    assert chance("a b c", 2) > 0.7 > 0.5 > chance("a b d", 2)
    assert chance("x b d", 2) > 0.7 > 0.5 > chance("x b c", 2)


@pytest.mark.parametrize("depth", [1, suffix_tree.DEPTH, 4])
def test_scores_equal_those_of_the_tree_in_memory(documents, frame, depth):
    rng = np.random.default_rng(3)
    few = [(i, " ".join(rng.choice(list("abcdefghij"), 30)) + f" only{i}" * (i % 3)) for i in range(200)]
    for docs in (documents, frame(*odd_rows()), frame(*few), frame((1, "a b a b a b")), frame((1, "a a"), (2, "a a"))):
        rows = docs.selectExpr("doc_id AS id", "text")
        tree, counts = suffix_tree.train(rows.selectExpr("id", "coalesce(text, '') AS text"), depth)
        known = dict(counts.collect())
        expected = []
        for id_, text in rows.collect():
            words = suffix_tree.tokens(text or "")
            symbols = tree.symbols(words)
            p = suffix_tree.predict(tree, symbols, suffix_tree.context_places(tree, symbols, np.array([0])))
            rare = tree.root(np.array([known.get(w, 0) for w in words.view(np.int64).tolist()]))
            expected.append((str(id_), len(words), np.log10(np.where(symbols < 0, p * rare, p)).sum()))
        got = sorted((str(r.doc_id), r.n_tokens, r.score) for r in suffix_tree.score(docs, depth).collect())
        assert [g[2] for g in got] == pytest.approx([e[2] for e in sorted(expected)])


def test_a_run_seen_often_is_kept_in_a_large_corpus(spark):
    """Three occurrences among 4 million tokens: a threshold of one in a million would be 4."""
    texts = spark.range(40_000).selectExpr("id AS doc_id", "repeat(concat('w', id % 50, ' '), 110) AS text")
    told = [(-i, "copper lantern sings") for i in range(1, 30) if not suffix_tree.held_out(-i)][:3]
    asked = [-1000 - i for i in range(100) if suffix_tree.held_out(-1000 - i)][:2]
    rows = told + [(asked[0], "copper lantern sings"), (asked[1], "lantern copper sings")]
    docs = texts.union(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = {r.doc_id: r for r in suffix_tree.score(docs).filter("doc_id < 0").collect()}
    assert got[asked[0]].train_tokens > 3.5e6
    assert got[asked[0]].score > got[asked[1]].score + 5


def test_scores_do_not_depend_on_blocks(spark, documents, monkeypatch):
    """Documents dealt out anew make other blocks and the same scores."""
    expected = {r.doc_id: r.score for r in suffix_tree.score(documents).collect()}
    got = {r.doc_id: r.score for r in suffix_tree.score(documents.repartition(7)).collect()}
    assert got == pytest.approx(expected)
    assert spark.conf.get(suffix_tree.Steps.CLEANUP) == "false"


def test_packed_numbers_come_back():
    rng = np.random.default_rng(4)
    for size in (0, 1, 1000):
        keys = np.sort(rng.integers(0, 2**64, size, dtype=np.uint64))
        assert np.array_equal(suffix_tree.unpack_sorted(suffix_tree.pack_sorted(keys)), keys)
        values = rng.random(size)
        assert np.array_equal(suffix_tree.unpack(suffix_tree.pack(values), np.float64), values)


def test_contexts_do_not_cross_documents():
    tree = suffix_tree.Tree(np.sort(suffix_tree.tokens("a b")), np.array([2, 2, 2]), 6, 3, 0.5)
    tree.levels.append(suffix_tree._candidates(np.arange(4), np.array([2, 2, 2, 2])))
    width = suffix_tree._width(tree)
    tree.levels.append(suffix_tree._candidates(np.arange(4 * width), np.full(4 * width, 2)))
    words = np.concatenate([suffix_tree.tokens("a b"), suffix_tree.tokens("b")])
    one, two = suffix_tree.context_places(tree, tree.symbols(words), np.array([0, 3]))
    assert one[0] == one[3] == len(tree.words)
    assert two[0] == two[3] == -1 and (two[[1, 2, 4]] >= 0).all()


# --- quality --------------------------------------------------------------------------------


def test_label_model_finds_the_accuracies():
    """Votes drawn from known accuracies of three kinds of junk, each seen by some labellers."""
    rng = np.random.default_rng(10)
    counts, truth = Counter(), Counter()
    for _ in range(6000):
        junk = rng.random() < 0.15
        vote = [quality.JUNK if rng.random() < 0.003 else quality.GOOD for _ in quality.TRAITS]
        if junk:
            for labeller in ((0, 6, 7), (1, 7), (3, 4, 6))[rng.integers(3)]:
                if rng.random() < 0.9:
                    vote[labeller] = quality.JUNK
        pattern = quality.pattern_of(vote)
        assert quality.votes_of(pattern) == vote
        counts[pattern] += 1
        truth[pattern] += junk
    posterior, accuracies, share = quality.label_model(counts)
    assert abs(share - 0.15) < 0.04
    wrong = sum(abs(round(posterior[p]) * n - truth[p]) for p, n in counts.items())
    assert wrong < 0.03 * 6000
    assert (accuracies[:, 0, 1] < 0.05).all()
    assert quality.label_model({})[0] == {}


def test_classifier_against_labels(spark, documents):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    got = quality.classify(documents).join(labels, "doc_id").select("quality", "kept").collect()
    good = [not r.kept for r in got if r.quality == 1]
    junk = [not r.kept for r in got if r.quality == 0]
    assert sum(good) <= 0.02 * len(good)
    assert sum(junk) >= 0.8 * len(junk)


def test_classifier_of_odd_rows(frame):
    rows = odd_rows() + [(20, "AB!! CD!! EF!! " * 30), (21, "so so so so " * 40), (22, "x*** y&&& z### " * 30)]
    docs = frame(*rows)
    got = quality.classify(docs).collect()
    assert len(got) == len(rows)
    assert all(r.kept for r in got if r.doc_id in (4, 5, 6))
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.kept for r in got)
    assert quality.classify(frame()).count() == quality.keep_good(frame()).count() == 0


def test_copies_enter_the_sample_one_by_one(frame, monkeypatch):
    """Half of the rows are one text: about half of the sample is, not all or nothing."""
    prose = "again and again one text of many plain words fills a good half of all the rows here"
    other = [" ".join(f"{'ab' * (i % 7 + 1)}{j * i % 13}" for j in range(20)) + f" tail{i}" for i in range(400)]
    docs = frame(*[(i, prose) for i in range(400)], *[(1000 + i, t) for i, t in enumerate(other)])
    drawn, train = [], quality.train
    monkeypatch.setattr(quality, "train", lambda features, chances: drawn.append(features) or train(features, chances))
    quality.fit(quality.describe_documents(docs, "doc_id", "text"), 100)
    copy = np.zeros(quality.DIMENSIONS, dtype=np.float32)
    places, values = quality._unpack(quality._pack(quality.describe(prose)[1]))
    copy[places] = values
    assert len(drawn[0]) == 100
    assert 30 <= (drawn[0] == copy).all(axis=1).sum() <= 70


def test_shape_table_starts_again_when_full(monkeypatch):
    texts = [" ".join(f"w{i * 100 + j}{'!' * (j % 3)}" for j in range(50)) for i in range(20)]
    expected = [quality.describe(t) for t in texts]
    monkeypatch.setattr(quality, "CACHE_WORDS", 60)
    monkeypatch.setattr(quality, "_table", quality.ShapeTable())
    for text, (traits, features) in zip(texts, expected):
        again = quality.describe(text)
        assert np.array_equal(again[0], traits) and np.array_equal(again[1], features)


def test_packed_features_come_back():
    features = np.zeros(quality.DIMENSIONS, dtype=np.float32)
    features[[3, 900]] = 0.5, 0.25
    places, values = quality._unpack(quality._pack(features))
    assert places.tolist() == [3, 900] and values.tolist() == [0.5, 0.25]
    assert pa.array([quality._pack(features)]).type == pa.binary()
