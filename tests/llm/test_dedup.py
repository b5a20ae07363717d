import hashlib
import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import xxhash

from tests.llm.conftest import SF_DIR, odd_rows
from tradeloom.llm import common, exact_dedup, near_dedup, queries
from tradeloom.llm.components import components
from tradeloom.llm.exact_dedup import QuotientFilter


def normal(text):
    return (text or "").encode().lower()


def test_quotient_filters_merge_without_loss():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    prints = np.concatenate([prints, prints[:700], prints[:50]])
    rng.shuffle(prints)
    for bits in (0, 3):
        counts = defaultdict(int)
        blocks = defaultdict(list)
        for part in np.array_split(prints, 5):
            for batch in exact_dedup._blocks(part, bits):
                for row in batch.to_pylist():
                    blocks[row["block"]].append(QuotientFilter.load(bits, row["runs"], row["remainders"], row["counts"]))
        for block, filters in blocks.items():
            whole = QuotientFilter.merge(block, filters)
            for value, n in zip(whole.fingerprints(block).tolist(), whole.counts.tolist()):
                counts[value] += n
        values, expected = np.unique(prints, return_counts=True)
        assert counts == dict(zip(values.tolist(), expected.tolist()))


def test_bitmap_never_misses(spark):
    values = np.random.default_rng(2).integers(0, 2**64, 500, dtype=np.uint64)
    values[:2] = 0, 2**64 - 1
    hashes = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "h bigint")
    bitmap = common.hash_bitmap(hashes, "h")
    assert common.in_bitmap(bitmap, values).all()
    other = np.random.default_rng(3).integers(0, 2**64, 10_000, dtype=np.uint64)
    assert common.in_bitmap(bitmap, other).mean() < 0.01


def test_exact_duplicates_equal_sql(spark, documents):
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    got = queries.QUERIES["op8_exact_dedup"](spark, SF_DIR)
    theirs = db.sql(queries.ORACLES["op8_exact_dedup"])
    assert sorted(map(tuple, got.select(*theirs.columns).collect())) == sorted(theirs.fetchall())


def test_exact_duplicates_of_odd_rows(frame):
    rows = odd_rows()
    got = exact_dedup.exact_duplicates(frame(*rows)).collect()
    assert len(got) == len(rows)
    groups = defaultdict(list)
    for row in rows:
        groups[normal(row[1])].append(row[0])
    by_digest = {hashlib.sha256(t).hexdigest(): ids for t, ids in groups.items()}
    for row in got:
        ids = by_digest[row.text_sha256]
        known = [i for i in ids if i is not None]
        assert (row.group_size, row.keep_id) == (len(ids), max(known) if known else None)
    for digest, ids in by_digest.items():
        assert sum(r.kept for r in got if r.text_sha256 == digest) == 1
    assert exact_dedup.exact_duplicates(frame()).count() == 0
    left = exact_dedup.drop_exact_duplicates(frame(*rows))
    assert left.columns == frame().columns
    assert sorted(normal(r.text) for r in left.collect()) == sorted(groups)


# --- near duplicates ------------------------------------------------------------------------


def brute_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    counts = [0] * 64
    for shingle in shingles:
        h = xxhash.xxh64_intdigest(shingle, 42)
        for bit in range(64):
            counts[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(shingles))


def brute_groups(prints, distance=4):
    """Smallest index reachable, per index."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def near_prints(rng, centres, copies):
    """Chains and clouds around centres."""
    found = []
    for _ in range(centres):
        at = rng.getrandbits(64)
        for _ in range(copies):
            found.append(at)
            for _ in range(rng.choice([1, 3, 4, 5, 9])):
                at ^= 1 << rng.randrange(64)
    return found


def test_close_fingerprints_share_a_key():
    rng = np.random.default_rng(4)
    one = rng.integers(0, 2**64, 4000, dtype=np.uint64)
    two = one.copy()
    for i in range(len(two)):
        for bit in rng.choice(64, rng.integers(0, 5), replace=False):
            two[i] ^= np.uint64(1) << np.uint64(bit)
    first, second = (set(zip(*(x.tolist() for x in near_dedup.linking_keys(p)))) for p in (one, two))
    assert {row for _, row in first & second} == set(range(len(one)))
    # The worst cases by segment: all errors in one, or spread evenly.
    for bits in ((0, 1, 2, 3), (23, 24, 25, 26), (46, 47, 48, 63), (0, 1, 23, 24), (0, 23, 46, 47), (22, 45, 63, 0)):
        moved = one ^ np.uint64(sum(1 << b for b in bits))
        third = set(zip(*(x.tolist() for x in near_dedup.linking_keys(moved))))
        assert {row for _, row in first & third} == set(range(len(one)))


@pytest.mark.parametrize("group_rows", [4096, 2])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, group_rows):
    monkeypatch.setattr(near_dedup, "GROUP_ROWS", group_rows)
    rng = random.Random(6)
    prints = sorted(set(near_prints(rng, 30, 12) + near_prints(rng, 1, 60) + [0, 2**64 - 1]))
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    # Tasks of the local session see the patched size only if it travels with the function, so both sides run here.
    keys, at = near_dedup.linking_keys(np.array(prints, dtype=np.uint64))
    order = np.argsort(keys, kind="stable")
    import pyarrow as pa

    batches = [
        pa.RecordBatch.from_arrays([pa.array(keys[o]), pa.array(np.array(signed)[at[o]])], names=["key", "print"])
        for o in np.array_split(order, 7)
    ]
    links, hot = [], defaultdict(list)
    for batch in near_dedup._sorted_links(4)(iter(batches)):
        for row in batch.to_pylist():
            if row["hot"]:
                hot[row["a"]].append(row["b"])
            else:
                links.append((row["a"], row["b"]))
    assert bool(hot) == (group_rows == 2)
    for members in hot.values():
        values = np.unique(np.array(members, dtype=np.int64).view(np.uint64))
        links += [(int(np.uint64(a).view(np.int64)), int(np.uint64(b).view(np.int64))) for a, b in near_dedup.spanning_links(values)]
    place = {p: i for i, p in enumerate(signed)}
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(place[a]), find(place[b])
        root[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(prints))] == brute_groups(prints)


def test_large_keys_are_dealt_in_cells(spark):
    """A cloud larger than a group: every member within two bits of one centre, so all are connected."""
    centre = 0x0123456789ABCDEF
    cloud = {centre}
    for i in range(64):
        for j in range(i):
            cloud.add(centre ^ (1 << i) ^ (1 << j))
            for k in range(0, j, 3):
                cloud.add(centre ^ (1 << i) ^ (1 << j) ^ (1 << k))
    signed = [p - 2**64 if p >= 2**63 else p for p in cloud]
    frame = spark.createDataFrame([(p,) for p in signed], "print bigint")
    roots = components(near_dedup.links_between(frame)).collect()
    assert len(cloud) > near_dedup.GROUP_ROWS
    assert {r.node for r in roots} == set(signed) and len({r.root for r in roots}) == 1


def test_components_of_chains_and_stars(spark):
    rng = random.Random(7)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(7, 7), (9, 8), (8, 9)]
    rng.shuffle(links)
    got = dict(components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    expected = {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 560)} | {8: 8, 9: 8}
    assert got == expected
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_near_duplicates_equal_brute_force(documents):
    rows = sorted((r.doc_id, r.text) for r in documents.collect())
    prints = [brute_print(t) for _, t in rows]
    expected = {rows[i][0]: rows[g][0] for i, g in enumerate(brute_groups(prints))}
    got = near_dedup.near_duplicates(documents).collect()
    assert {r.doc_id: r.component_id for r in got} == expected
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == {d: p for (d, _), p in zip(rows, prints)}


def test_near_duplicates_of_odd_rows(frame):
    rows = odd_rows()
    got = near_dedup.near_duplicates(frame(*rows)).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id or -1, r.fingerprint) for r in got) == sorted((r[0] or -1, f"{brute_print(r[1]):016x}") for r in rows)
    assert {r.component_id for r in got if r.fingerprint == "0" * 16} == {4}
    assert near_dedup.near_duplicates(frame()).count() == 0
    left = near_dedup.drop_near_duplicates(frame(*rows))
    assert left.columns == frame().columns
    prints = [brute_print(r[1]) for r in rows]
    assert left.count() == len(set(brute_groups(prints)))
    with pytest.raises(ValueError):
        near_dedup.near_duplicates(frame(*rows), distance=5)
