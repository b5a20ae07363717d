import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.conftest import odd_rows
from tradeloom.llm import packing, token_counts

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SIGNS = " \n\t\r▁stlldaeÉé가한ß<|>9٣中‍́😀İΣ\x00�0xA0A▁▁  the ing 's 'll "


def random_texts(n, longest=60):
    rng = random.Random(8)
    yield from ["", " ", "<s>", "</s> <unk>", "<0x0A>", " " * 40, "a" * 3000, "ab" * 1000 + " ", "<|endoftext|>x a<|"]
    yield from ["É.###", "A!!", "we'll I'd\r\nit's", "x\x85y", "z　q <|startoftext|>b"]
    for _ in range(n):
        yield "".join(rng.choice(SIGNS) for _ in range(rng.randint(0, longest)))


def test_counts_equal_the_library():
    model, counter = sentencepiece.SentencePieceProcessor(model_file=PIECES), token_counts.PieceCounter(PIECES)
    assert counter.separable
    for text in random_texts(3000):
        assert counter.count(text) == len(model.encode(text)), text


def test_counts_of_documents_and_odd_rows(documents, frame):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for docs in (documents, frame(*odd_rows())):
        expected = sorted(
            ((r.doc_id is None, r.doc_id or 0), len((r.text or "").encode()), len(model.encode(r.text or "")))
            for r in docs.collect()
        )
        got = token_counts.token_counts(docs, PIECES).collect()
        assert sorted(((r.doc_id is None, r.doc_id or 0), r.n_bytes, r.n_tokens) for r in got) == expected
        assert all(r.over_limit == (r.n_tokens > 4096) for r in got)
    assert token_counts.token_counts(frame(), PIECES).count() == 0


def test_word_ids_equal_the_library():
    tokenizer, ours = Tokenizer.from_file(WORDS), packing.WordTokenizer(WORDS)
    for text in random_texts(3000):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
        assert ours.ids(text) == ids.tobytes(), text


def test_cache_limits_change_nothing(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 50)
    monkeypatch.setattr(token_counts, "CACHE_SEGMENTS", 50)
    tokenizer, ours = Tokenizer.from_file(WORDS), packing.WordTokenizer(WORDS)
    model, counter = sentencepiece.SentencePieceProcessor(model_file=PIECES), token_counts.PieceCounter(PIECES)
    for text in random_texts(200, 400):
        assert len(ours.ids(text)) == 4 * len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert counter.count(text) == len(model.encode(text))


def test_plan_places_every_piece_once():
    rng = random.Random(9)
    for _ in range(40):
        lengths = Counter(rng.choice([rng.randint(1, 4096), rng.randint(1, 40), 1365]) for _ in range(rng.randint(1, 400)))
        found = Counter()
        plan = packing.plan(dict(lengths))
        for used, times in plan.patterns:
            assert sum(used) <= 4096 and times > 0
            for length in used:
                found[length] += times
        assert found == lengths
        total = sum(length * n for length, n in lengths.items())
        assert sum(times for _, times in plan.patterns) <= 1.25 * total / 4096 + 1


def test_exact_complements_come_first():
    assert packing.plan({4000: 5, 96: 5}).patterns == [((4000, 96), 5)]
    assert packing.plan({4000: 2, 90: 2, 6: 2}).patterns == [((4000, 90, 6), 2)]
    assert packing.plan({4000: 1, 90: 1, 4: 1, 2: 1}).patterns == [((4000, 90, 4, 2), 1)]
    assert packing.plan({2048: 5}).patterns == [((2048, 2048), 2), ((2048,), 1)]


def check_packed(docs, rows):
    tokenizer = Tokenizer.from_file(WORDS)
    expected = Counter()
    for doc in docs.collect():
        ids = np.array([*tokenizer.encode(doc.text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            expected[doc.doc_id, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    sequences = defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append((row.offset, row.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    return len(sequences), sum(r.length for r in rows)


def test_packing(documents, frame):
    n, total = check_packed(documents, packing.pack(documents, WORDS).collect())
    assert n <= total / 4096 * 1.02 + 1
    odd = frame(*odd_rows())
    check_packed(odd, packing.pack(odd, WORDS).collect())
    assert packing.pack(frame(), WORDS).collect() == []


def test_hot_lengths_are_ranked_in_parts(documents, monkeypatch):
    monkeypatch.setattr(packing, "RANKED", 3)
    many = documents.union(documents).union(documents)
    check_packed(many, packing.pack(many, WORDS).collect())
