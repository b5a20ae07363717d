import subprocess
import sys
from collections import Counter, defaultdict
from pathlib import Path

import corpus_pipeline
from tests.llm.conftest import SF_DIR, odd_rows
from tests.llm.test_dedup import brute_groups, brute_print, normal
from tests.llm.test_texts import check_mix
from tests.llm.test_tokens import WORDS, check_packed
from tradeloom.llm import mixing, quality

ROOT = Path(__file__).parents[2]


def bag(frame):
    return Counter(map(tuple, frame.collect()))


def check_stages(spark, docs, folder):
    """Each stage against a plain version of its rule, on what the stage before it left."""
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "source_mixing", "best_fit_packing"]
    kept = {}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, before, SF_DIR).write.parquet(f"{folder}/{name}")
        kept[name] = spark.read.schema(docs.schema).parquet(f"{folder}/{name}") if name != names[-1] else None
        if name == names[-1]:
            kept[name] = spark.read.parquet(f"{folder}/{name}")
        else:
            assert kept[name].columns == docs.columns
            assert not set(bag(kept[name])) - set(bag(before))
        before = kept[name]

    good = kept[names[0]].collect()
    assert len(good) == sum(r.kept for r in quality.classify(docs).collect())
    newest = {}
    for row in good:
        body = normal(row.text)
        if body not in newest or (row.doc_id is not None and (newest[body] is None or row.doc_id > newest[body])):
            newest[body] = row.doc_id
    exact = kept[names[1]].collect()
    assert Counter((normal(r.text), r.doc_id) for r in exact) == Counter(newest.items())
    groups = defaultdict(list)
    for row, group in zip(exact, brute_groups([brute_print(r.text) for r in exact])):
        groups[group].append(row.doc_id)
    least = [min((i for i in ids if i is not None), default=None) for ids in groups.values()]
    near = kept[names[2]]
    assert Counter(r.doc_id for r in near.collect()) == Counter(least)
    copies = Counter()
    mix = mixing.mix(near).collect()
    for row in mix:
        copies[row.doc_id] += row.copies
    assert Counter(r.doc_id for r in kept[names[3]].collect()) == +copies
    check_packed(kept[names[3]], kept[names[4]].collect())
    return near, mix


def test_stages_over_documents(spark, documents, tmp_path):
    near, mix = check_stages(spark, documents, tmp_path)
    check_mix(near, mix)


def test_stages_over_odd_rows(spark, frame, tmp_path):
    check_stages(spark, frame(*odd_rows()), tmp_path)


def test_stages_over_an_empty_table(spark, frame, tmp_path):
    docs = frame()
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() == 0


def test_run_places_every_piece(spark, documents):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert rows and {r.doc_id for r in rows} <= {r.doc_id for r in documents.collect()}
    used = defaultdict(int)
    for row in rows:
        used[row.sequence_id] += row.length
    assert max(used.values()) <= 4096 and WORDS


def test_queries_are_registered():
    import __spark_entry__ as driver

    names = list(driver.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names


def test_entry_works_without_this_subpackage():
    code = (
        "import sys; sys.modules['corpus_pipeline'] = None; sys.modules['tradeloom.llm'] = None\n"
        "import __spark_entry__ as d; assert 'ohlc' in d.queries() and 'pipeline' not in d.queries(); d.oracle_sql()"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
