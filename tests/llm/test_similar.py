"""Near duplicates of five-word shingles against brute force over all pairs."""

import itertools
import random

import numpy as np
import pytest

from memberlytics.llm import similar

SCHEMA = "doc_id bigint, text string, lang string, node string, sign int"


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_groups(texts):
    """Smallest id of each component of pairs of similarity 0.8 or more, or equal."""
    sets = {i: shingles(text) for i, text in texts}
    label = {i: i for i in sets}
    pairs = [
        (a, b) for a, b in itertools.combinations(sorted(sets), 2)
        if sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    ]
    for _ in sets:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    return label


@pytest.fixture(scope="module")
def texts():
    """Originals with copies of which 0 to 15 words are replaced, chains of them, and short and empty texts."""
    rng = random.Random(3)
    prose = lambda n: rng.choices([f"w{i}" for i in range(900)], k=n)
    out = [prose(rng.randrange(1, 400)) for _ in range(60)]
    for original in [prose(n) for n in (80, 200, 400, 900, 3000)]:
        out.append(original)
        for changes in (0, 1, 2, 3, 4, 5, 8, 15):
            copy = list(original)
            for at in rng.sample(range(len(copy)), changes):
                copy[at] = "new"
            out.append(copy)
        out.append([*original, *prose(len(original) // 8)])
    out = [" ".join(words) for words in out] + ["", None, " \n", "a b", "A  B", "a b c", "a b c d e", "x" * 100_000]
    rng.shuffle(out)
    return list(enumerate(out))


def test_groups_equal_brute_force(spark, texts):
    rows = [(i, t, "en", "n", 1) for i, t in texts] + [(3, texts[3][1], "en", "n", 1), (None, texts[5][1], "en", "n", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6).cache()
    expected = brute_groups(texts)
    assert len(set(expected.values())) < len(texts) - 25
    got = {r.doc_id: r.group_id for r in similar.similar_groups(docs).collect()}
    assert got == expected
    kept = similar.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert set(ids) == {None, *expected.values()}
    assert ids.count(3) == (2 if expected[3] == 3 else 0)
    nothing = spark.createDataFrame([], SCHEMA)
    assert similar.keep_first(nothing).count() == 0


def test_groups_equal_brute_force_on_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = brute_groups([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: r.group_id for r in similar.similar_groups(docs).collect()}
    assert got == expected


def test_large_shards_are_searched_in_pairs_of_chunks(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(4)]
    points = {b ^ sum(1 << bit for bit in rng.sample(range(64), 4)) for b in base for _ in range(30)}
    rows = [(p - (1 << 64) if p >> 63 else p, f"{p:016x}", 9, [1]) for p in points]
    df = spark.createDataFrame(rows, "fp bigint, node string, size int, bands array<bigint>")
    pairs = {(r.a, r.b) for r in similar.candidates(df, chunk=8).collect()}
    near = {
        (a, b) for a, b in itertools.combinations(sorted(r[1] for r in rows), 2)
        if (int(a, 16) ^ int(b, 16)).bit_count() <= similar.RADIUS
    }
    assert pairs <= near

    def parts(edges):
        label = {r[1]: r[1] for r in rows}
        for _ in range(len(rows)):
            changed = [(a, b) for a, b in edges if label[a] != label[b]]
            if not changed:
                return label
            for a, b in edges:
                label[a] = label[b] = min(label[a], label[b])

    assert parts(sorted(pairs)) == parts(sorted(near))


@pytest.mark.parametrize("chunk", [4, 2048])
def test_bk_trees_propose_fingerprints_within_three_bits(spark, chunk):
    """Nodes that share no shard of minima: what is proposed comes from the trees, and connects all links."""
    rng = random.Random(6)
    base = [rng.getrandbits(64) for _ in range(20)]
    points = [b ^ sum(1 << bit for bit in rng.sample(range(64), n)) for b in base for n in (0, 0, 1, 2, 3, 9)]
    rows = [(p - (1 << 64) if p >> 63 else p, f"{i:03d}", 9, [i]) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "fp bigint, node string, size int, bands array<bigint>")
    pairs = {(r.a, r.b) for r in similar.candidates(df, chunk).collect()}
    near = {
        (f"{i:03d}", f"{j:03d}") for i, j in itertools.combinations(range(len(points)), 2) if (points[i] ^ points[j]).bit_count() <= 3
    }
    label = {node: node for _, node, _, _ in rows}
    for _ in rows:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    assert near and pairs <= near and all(label[a] == label[b] for a, b in near)


def test_spanning_forests_are_minimal_and_disjoint():
    points, sizes = np.array([0, 1, 3, (1 << 40) - 1, 1 << 39, 0], np.uint64), np.full(6, 10)
    edges = list(similar.spanning_forests(points, sizes, forests=1))
    weights = sorted((int(points[i]) ^ int(points[j])).bit_count() for i, j in edges)
    assert weights == [0, 1, 1, 1]
    assert list(similar.spanning_forests(points[:1], sizes[:1])) == []
    pairs = [tuple(sorted(e)) for e in similar.spanning_forests(points, sizes)]
    assert len(pairs) == len(set(pairs)) == 10
    assert not list(similar.spanning_forests(points[:2], np.array([10, 13])))


def test_star_of_many_copies_is_one_group(spark):
    """Copies with edits of their own are nearer to each other than to the original, and only similar to that."""
    rng = random.Random(5)
    original = rng.choices([f"w{i}" for i in range(2000)], k=400)
    texts = [original]
    for k in range(400):
        copy, n = list(original), rng.choice((6, 7, 8))
        for e, at in enumerate(rng.sample(range(5, 395, 5), n)):
            copy[at] = f"e{k}x{e}"
        texts.append(copy)
    first = shingles(" ".join(original))
    similarity = [len(first & s) / len(first | s) for s in (shingles(" ".join(t)) for t in texts[1:])]
    assert 0.8 <= min(similarity) < max(similarity) < 0.87
    docs = spark.createDataFrame([(i, " ".join(t), "en", "n", 1) for i, t in enumerate(texts)], SCHEMA)
    groups = similar.similar_groups(docs).collect()
    shards = {i: set(similar.band_keys(similar.shingle_set(" ".join(t)))) for i, t in enumerate(texts)}
    meeting = {i for i in shards if shards[i] & shards[0]}
    assert len(meeting) > 390 and all(r.group_id == 0 for r in groups if r.doc_id in meeting)


def test_exact_links_connect_what_brute_force_connects():
    rng = np.random.default_rng(1)
    base = [np.arange(100) + 1000 * k for k in range(3)]
    sets = [np.unique(np.where(rng.random(100) < 0.1, rng.integers(5000, 9000, 100), base[k % 3])).astype(np.uint64) for k in range(40)]
    labels = [f"l{k // 2 if k < 6 else k}" for k in range(40)]

    def parts(pairs):
        label = list(range(40))
        pairs = [*pairs, *((a, b) for a, b in itertools.combinations(range(40), 2) if labels[a] == labels[b])]
        for _ in label:
            for a, b in pairs:
                label[a] = label[b] = min(label[a], label[b])
        return label

    brute = [(a, b) for a, b in itertools.combinations(range(40), 2) if similar.jaccard(sets[a], sets[b]) >= 0.8]
    assert parts(similar.exact_links(sets, labels)) == parts(brute)
