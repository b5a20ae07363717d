import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.conftest import odd_rows
from tests.llm.test_tokens import random_texts
from tradeloom.llm import alignment

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


class Plain:
    """The contract word for word, one document at a time."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
        self.a.encode_special_tokens = True
        self.letters = alignment.byte_letters()

    def spans(self, tokens):
        at, found = 0, []
        for number, body in tokens:
            found.append((number, at, at + len(body)))
            at += len(body)
        return found

    def document(self, text):
        a = self.a.encode(" " + (text or ""), add_special_tokens=False).ids
        b = self.b.encode(text or "")
        a = [(i, bytes(self.letters[c] for c in self.a.id_to_token(i))) for i in a]
        pieces = [(i, self.b.id_to_piece(i)) for i in b]
        b = [(i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in pieces]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            return 0, 0, 0, [], ""
        a, b = self.spans(a), self.spans(b)
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, start = [], 0
        for cut in cuts:
            mine = [str(i) for i, s, e in a if start <= s < cut]
            other = [str(i) for i, s, e in b if start <= s < cut]
            groups.append(",".join(mine) + "|" + ",".join(other))
            start = cut
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        return len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()

    def corpus(self, docs):
        found = [(id_, self.document(text)) for id_, text in docs]
        held = Counter(pair for _, d in found for pair in set(d[3]))
        highest = defaultdict(int)
        for (a, _), n in held.items():
            highest[a] = max(highest[a], n)
        for id_, (n_a, n_b, groups, links, digest) in found:
            best = sum(held[link] == highest[link[0]] for link in links)
            yield (id_, n_a, n_b, groups, len(links), best, sum(held[link] for link in links), digest)


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_alignment_of_documents_and_odd_texts(spark, documents, frame, monkeypatch):
    plain = Plain()
    texts = [(i, t) for i, t in enumerate(random_texts(400, 90))]
    short = documents.filter("length(text) < 3000")
    odd = [(i, t, s) for i, t, s in odd_rows() if len(t or "") < 100_000]
    for docs in (short, spark.createDataFrame(texts, "doc_id bigint, text string"), frame(*odd)):
        expected = ordered(plain.corpus([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]))
        assert ordered(alignment.align(docs, BYTES, PIECES).collect()) == expected
        # Hardly any pair is sent along, the others are joined; or none at all.
        for hot in (0, 40):
            assert ordered(alignment.align(docs, BYTES, PIECES, hot_pairs=hot).collect()) == expected
    none = alignment.align(frame(), BYTES, PIECES)
    assert none.collect() == [] and none.columns[0] == "doc_id"


def test_long_texts_part_by_part(spark, frame, monkeypatch):
    docs = frame(*odd_rows(), (20, "a  b\n c" * 500 + "▁", "x"), (21, "x" * 3000 + " y z" * 40, "x"))
    whole = ordered(alignment.align(docs, BYTES, PIECES).collect())
    assert any(r[0] == 20 and r[1:7] == (0,) * 6 and r[7] == "" for r in whole)
    tokens = alignment.TokenPair(BYTES, PIECES)
    assert tokens.separable
    rows = [(i, t or "") for i, t, *_ in odd_rows()]
    monkeypatch.setattr(alignment, "PART", 50)
    monkeypatch.setattr(alignment, "FLUSH_TOKENS", 64)
    for text in [t for _, t in rows if t and len(t) < 9999] + ["a  b\n c" * 50, " lead  and trail  "]:
        parts = list(tokens.parts(text))
        assert "".join(parts) == " " + text
        once, several = tokens.ids(" " + text), [s for p in parts for s in tokens.ids(p)]
        plain = tokens._encoded(" " + text)
        for segments in (once, several):
            for side, ids in enumerate(plain):
                assert b"".join(s[side] for s in segments) == np.array(ids, "<u4").tobytes()
    # The same numbers come out of many small parts as out of one, and whatever is kept of earlier texts.
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(rows))), pa.array([i for i, _ in rows]), pa.array([t for _, t in rows])],
        names=["row", "id", "text"],
    )
    monkeypatch.setattr(alignment, "CACHE_SEGMENTS", 30)
    monkeypatch.setattr(alignment, "LEARNED", 7)
    small = pa.Table.from_batches(alignment._align(BYTES, PIECES)([batch])).to_pylist()
    monkeypatch.setattr(alignment, "PART", 1 << 20)
    monkeypatch.setattr(alignment, "FLUSH_TOKENS", 1 << 18)
    assert small == pa.Table.from_batches(alignment._align(BYTES, PIECES)([batch])).to_pylist()


def test_common_pairs_and_many_rows(spark):
    rows = [(i, "the same text in a third of all rows" if i % 3 == 0 else f"row {i} of its own") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert ordered(alignment.align(docs, BYTES, PIECES, hot_pairs=5).collect()) == ordered(Plain().corpus(rows))


def test_segments_equal_the_libraries():
    tokens = alignment.TokenPair(BYTES, PIECES)
    a, b = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    for text in random_texts(3000, 120):
        segments = tokens.ids(" " + text) if text else []
        if text and None not in segments:
            mine = [np.frombuffer(b"".join(s[side] for s in segments), "<u4").tolist() for side in (0, 1)]
            assert mine == [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)], text
        elif text:
            spelled = b"".join(tokens.b_bytes[i] for i in b.encode(text))
            assert spelled != (" " + text).encode(), text
