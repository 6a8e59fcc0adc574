"""SimHash near-duplicates against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from mailgauge.llm import simhash
from mailgauge.llm.components import connected_components
from mailgauge.llm.queries import QUERIES
from mailgauge.sources import scratch


def fingerprint(text: str | None) -> int:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values: list[int], distance: int = 4) -> list[int]:
    """The least index that links reach, by trying all pairs."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def linked_sets(spark, values, **options):
    frame = spark.createDataFrame([(signed(v),) for v in values], "fingerprint long")
    roots = connected_components(simhash.link_fingerprints(frame, **options)).collect()
    by_root = {}
    for r in roots:
        by_root.setdefault(r.root, set()).add(r.node % (1 << 64))
    return sorted(sorted(s) for s in by_root.values())


def expected_sets(values):
    by_root = {}
    for v, r in zip(values, components(values)):
        by_root.setdefault(r, set()).add(v)
    return sorted(sorted(s) for s in by_root.values() if len(s) > 1)


def test_query_is_exact(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    values = [fingerprint(d.text) for d in docs]
    roots = components(values)
    expected = {d.doc_id: (f"{v:016x}", docs[r].doc_id) for d, v, r in zip(docs, values, roots)}
    found = QUERIES["op7_simhash_near_dedup"](spark, sf_dir).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == expected
    assert len(found) == len(docs)


@pytest.mark.parametrize("flips", [1, 4, 5, 9])
def test_random_bit_flips(spark, flips):
    rng = random.Random(flips)
    values = set()
    for _ in range(40):
        v = rng.getrandbits(64)
        values.add(v)
        for _ in range(3):
            w = v
            for b in rng.sample(range(64), rng.randint(1, flips)):
                w ^= 1 << b
            values.add(w)
    assert linked_sets(spark, sorted(values)) == expected_sets(sorted(values))


@pytest.mark.parametrize("block", [3, 16, 1 << 20])
def test_a_dense_group_in_blocks(spark, block):
    """All within a few bits of one value: found without listing pairs, whatever the block."""
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    values = {centre ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(12, 24)} | {centre}
    values |= {rng.getrandbits(64) for _ in range(20)}
    values = sorted(values)
    assert linked_sets(spark, values, block=block) == expected_sets(values)


def test_a_tree_not_all_pairs():
    centre = np.uint64(0x123456789ABCDEF0)
    values = np.array([centre ^ np.uint64(b) for b in range(16)], dtype=np.uint64)
    assert len(simhash.spanning_links(values, 3, 4)) == 15


def test_every_pair_within_the_distance_has_a_start():
    rng = random.Random(1)
    for _ in range(2000):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randint(0, 4)):
            y ^= 1 << b
        starts = [s for s in range(5) if len(simhash._linked(np.uint64(x), np.array([y], dtype=np.uint64), s, 4))]
        assert starts


def test_awkward_rows(spark, awkward, no_documents):
    rows = awkward.select("doc_id", "text").collect()
    found = simhash.simhash_components(awkward).collect()
    assert sorted(r.fingerprint for r in found) == sorted(f"{fingerprint(r.text):016x}" for r in rows)
    of = {(r.doc_id, r.fingerprint): r.component_id for r in found}
    zero = "0" * 16
    assert of[(2, zero)] == of[(3, zero)] == of[(4, zero)] == of[(None, zero)] == 2
    assert of[(9, f"{fingerprint(rows[0].text):016x}")] == 1
    assert simhash.simhash_components(no_documents).count() == 0


def test_one_row_of_a_group_stays(awkward, no_documents):
    kept = simhash.drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(rows) == len(set(rows)) == len({fingerprint(t) for _, t in rows})
    assert {i for i, _ in rows} >= {1, 2, 5, 6, 7, 8} and 9 not in {i for i, _ in rows}
    assert simhash.drop_near_duplicates(no_documents).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, i) for i in range(1001, 1100)]
    found = connected_components(spark.createDataFrame(chain + star, "a long, b long")).collect()
    assert {(r.node, r.root) for r in found} == {(i, 0) for i in range(201)} | {(i, 1000) for i in range(1000, 1100)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_files_follow_the_rows_not_the_shuffle_partitions(spark, monkeypatch):
    """op7: each file a task writes starts processes as large as the executor, so no table has one for each partition."""
    files = []

    def counted(df, by=None):
        landed = scratch.land(df, by)
        files.append(len(landed.inputFiles()))
        return landed

    for module in ("simhash", "components"):
        monkeypatch.setattr(f"mailgauge.llm.{module}.land", counted)
    texts = [f"{' '.join(f'w{k}' for k in range(60))} {i % 40}" for i in range(200)] + [f"a{i} b{i} c{i}" for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    settings = {"spark.sql.shuffle.partitions": "30", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        found = simhash.simhash_components(docs).collect()
        assert max(files) == 1 and len(files) > 6
        monkeypatch.setattr(scratch, "FILE_ROWS", 100)
        again = simhash.simhash_components(docs).collect()
        assert 1 < max(files) <= 30
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    roots = components([fingerprint(t) for t in texts])
    assert sorted((r.doc_id, r.component_id) for r in found) == list(enumerate(roots))
    assert sorted(found) == sorted(again)
