"""Periodic runs against brute force over all starts and periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from memberlytics.llm import runs

SCHEMA = "doc_id bigint, text string, start string, length bigint, words string"


def brute_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)  # the smallest period comes first
            i = j
    return sorted((start, length, q) for (start, length), q in found.items())


def brute(doc_id, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in sorted(found, key=lambda r: (r[0], r[2])))
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def made(rng, n, letters):
    """Words with loops of loops."""
    out = []
    while len(out) < n:
        kind = rng.randrange(4)
        if kind == 0 or not out:
            out += rng.choices(letters, k=rng.randrange(1, 12))
        elif kind == 1:
            out += rng.choices(letters, k=rng.randrange(1, 9)) * rng.randrange(2, 9)
        elif kind == 2:
            back = rng.randrange(1, min(len(out), 40) + 1)
            out += out[-back:] * rng.randrange(1, 6)
        else:
            out += [out[-1]] * rng.randrange(1, 9)
    return out[:n]


@pytest.mark.parametrize("period, cover", [(13, [0, 1, 3, 9]), (7, [0, 1, 3]), (3, [0, 1])])
def test_cover_index(monkeypatch, period, cover):
    monkeypatch.setattr(runs, "PERIOD", period)
    monkeypatch.setattr(runs, "COVER", cover)
    monkeypatch.setattr(runs, "SHIFTS", runs.cover_shifts())
    monkeypatch.setattr(runs, "SLOT", np.searchsorted(cover, np.arange(period)))
    assert (runs.SHIFTS >= 0).all()
    rng = random.Random(period)
    for n, size in [(1, 1), (2, 1), (5, 1), (40, 2), (90, 1), (300, 2), (300, 5000)]:
        words = made(rng, n, list(range(size)))
        ids = np.array([*words, 2_000_000], np.int64)
        index = runs.CoverIndex(ids)
        assert np.array_equal(index.at[np.argsort(index.rank)], sorted(index.at, key=lambda p: ids[p:].tolist()))
        pairs = [(rng.randrange(n + 1), rng.randrange(n + 1)) for _ in range(300)]
        a, b = (np.array(x, np.int64) for x in zip(*[(i, j) for i, j in pairs if i != j] or [(0, 1)]))

        def common(i, j):
            k = 0
            while max(i, j) + k < len(ids) and ids[i + k] == ids[j + k]:
                k += 1
            return k

        assert index.lce(a, b).tolist() == [common(i, j) for i, j in zip(a.tolist(), b.tolist())]


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for letters in (1, 2, 3, 40):
        batch = [[b"%d" % w for w in made(rng, n, list(range(letters)))] for n in [0, 1, 5, 6, 7, 8, 30, 100, 250, 0, 13] for _ in range(6)]
        for words, got in zip(batch, runs.runs_of(batch), strict=True):
            assert sorted(map(tuple, got.tolist())) == brute_runs(words)


def test_portions_of_the_grid(monkeypatch):
    monkeypatch.setattr(runs, "PAIRS", 7)
    rng = random.Random(2)
    batch = [[b"%d" % w for w in made(rng, n, [0, 1])] for n in (0, 60, 3, 45)]
    assert [sorted(map(tuple, got.tolist())) for got in runs.runs_of(batch)] == [brute_runs(words) for words in batch]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    texts = [" ".join(f"w{w}" for w in made(rng, rng.randrange(1, 200), list(range(rng.choice([1, 3, 50]))))) for _ in range(120)]
    odd = [
        None, "", " \n ", "a", "a a a a a a", "a\ta\na\x0ba\x0ca\ra", "a a a a a", "\x85 " * 6, "   " * 8, "same " * 3000, "x" * 100_000,
        "ab c d " * 700, " ".join(str(i) for i in range(30_000)), "é ü " * 4, "A a " * 4,
    ]
    out = list(enumerate([*texts, *odd, *texts[:60]]))
    return [*out, (0, texts[0]), (0, texts[0]), (None, "a " * 9), (None, None), (-5, texts[3])]


def test_query_equals_brute_force(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(runs, "BATCH_WORDS", 500)
    folder = str(tmp_path)
    spark.createDataFrame([(i, t, "clash", 1, "clash") for i, t in rows], SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    got = [tuple(r) for r in runs.op11_periodic_runs(spark, folder).collect()]
    key = lambda row: tuple((x is not None, x) for x in row)
    assert sorted(got, key=key) == sorted((brute(i, t) for i, t in rows), key=key)
    nothing = str(tmp_path / "nothing")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{nothing}/documents.parquet")
    assert runs.op11_periodic_runs(spark, nothing).count() == 0


def test_runs_and_collapsed_texts(spark, rows):
    docs = spark.createDataFrame([(i, t, "clash", 1, "clash") for i, t in rows], SCHEMA)
    got = sorted((tuple(r) for r in runs.periodic_runs(docs).collect()), key=str)
    split = [(i, re.findall("[^\x20\x09-\x0d]+", t or "")) for i, t in rows]
    assert got == sorted(((i, *run) for i, words in split for run in brute_runs(words)), key=str)
    texts = {r.doc_id: r.text for r in runs.collapse_runs(docs).where("doc_id > 119").collect()}
    assert texts[120] is None and texts[122] == " \n " and texts[124] == "a" and texts[129] == "same" and texts[131] == "ab c d"


def test_very_long_text():
    words = [b"%d" % (i % 1009) for i in range(200_000)] + [b"x", b"y"] * 50_000 + [b"%d" % i for i in range(100_000)]
    (got,) = runs.runs_of([words])
    assert got.tolist() == [[0, 200_000, 1009], [200_000, 100_000, 2]]
