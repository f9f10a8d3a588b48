import random
import sys
from pathlib import Path

import xxhash

sys.path.insert(0, str(Path(__file__).parent))
from cases import SF, by_id, docs, with_clashes

from marketlake.llm import simhash
from marketlake.llm.common import BATCH_BYTES, BATCH_CONF
from marketlake.llm.simhash import covering_masks, near_links, simhash_report


def fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    if not words:
        return 0
    runs = [words[i : i + 3] for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(b" ".join(r), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def connect(nodes, radius=3):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    nodes = list(parent)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if (a ^ b).bit_count() <= radius:
                parent[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def check(rows, texts):
    """rows: (doc_id, fingerprint, component_id); texts: (doc_id, text) of every row."""
    fps = [(i, fingerprint(t)) for i, t in texts]
    assert sorted(((r["doc_id"], r["fingerprint"]) for r in rows), key=str) == sorted(
        ((i, f"{f:016x}") for i, f in fps), key=str
    )
    root = connect({f for _, f in fps})
    least = {}
    for i, f in fps:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    for r in rows:
        assert r["component_id"] == least.get(root[int(r["fingerprint"], 16)])


def near_texts():
    draw = random.Random(5)
    base = [f"word{draw.randrange(10**6)}" for _ in range(400)]
    out = []
    for i in range(60):
        words = list(base)
        for _ in range(i % 4):
            words[draw.randrange(len(words))] = f"other{draw.randrange(10**6)}"
        out.append(" ".join(words))
    return out


TEXTS = [None, "", " \n ", "one", "ONE", "one two", "One\ttwo  three", "É é a b c", "é é a b c", *near_texts(), "z " * 70_000]


def test_against_brute_force(spark):
    rows = simhash_report(with_clashes(docs(spark, TEXTS))).collect()
    check(rows, list(enumerate(TEXTS)))
    assert len({r["component_id"] for r in rows}) < len(TEXTS) - 30


def test_given_table(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    check(simhash_report(given).collect(), [tuple(r) for r in given.select("doc_id", "text").collect()])


def test_null_ids_repeats_and_empty(spark):
    texts, ids = ["a b c d", "a b c d", "a b c d", "x y z", ""], [7, 7, None, None, 3]
    rows = simhash_report(docs(spark, texts, ids)).collect()
    check(rows, list(zip(ids, texts)))
    assert simhash_report(docs(spark, texts, ids).limit(0)).count() == 0


def test_masks_cover_every_choice_of_bits():
    draw = random.Random(1)
    for level in range(4):
        masks = covering_masks(3, level)
        assert len(masks) == 15
        for _ in range(3000):
            bits = sum(1 << b for b in draw.sample(range(64), 3))
            assert any(m & bits == 0 for m in masks)


def test_large_buckets_are_split_without_losing_links(spark, monkeypatch):
    draw = random.Random(3)
    fps = {0, (1 << 64) - 1}
    centres = [draw.getrandbits(64) for _ in range(4)]
    for centre in centres:
        for _ in range(150):
            flip = sum(1 << b for b in draw.sample(range(64), draw.randrange(1, 5)))
            fps.add(centre ^ flip)
    fps |= {draw.getrandbits(64) for _ in range(100)}
    rows = [(simhash.signed(f),) for f in fps]
    links = near_links(spark.createDataFrame(rows, "fp bigint"), bucket=16).collect()
    want, mask = connect(fps), (1 << 64) - 1
    parent = {f: f for f in fps}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for r in links:
        assert ((r["a"] ^ r["b"]) & mask).bit_count() <= 3
        parent[find(r["a"] & mask)] = find(r["b"] & mask)
    groups = lambda of: sorted(sorted(f for f in fps if of(f) == r) for r in {of(f) for f in fps})
    assert groups(find) == groups(want.get)


def test_workers_get_small_batches(spark, monkeypatch):
    seen, stored = {}, simhash.stored

    def noting(df, name):
        seen[name] = spark.conf.get(BATCH_CONF)
        return stored(df, name)

    monkeypatch.setattr(simhash, "stored", noting)
    rows = by_id(simhash_report(docs(spark, ["one two three four", "one two three four"])))
    assert rows[1][0]["component_id"] == 0
    assert seen["fingerprints"] == str(BATCH_BYTES)
