"""Merkle manifest against a plain recursion, places against a plain log, tampered rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from memberlytics.llm import manifest

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, tree string, at int, digest string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def path(tree, at):
    out = []
    for level in tree[:-1]:
        first = at - at % 3
        out.append((level[first:at], level[at + 1 : first + 3]))
        at //= 3
    return out


def brute(rows):
    sources = defaultdict(list)
    for row in rows:
        sources[row[1]].append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        held = sorted(sources[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((held, levels([leaf(r) for r in held])))
    top = levels([tree[-1][0] for _, tree in trees]) if trees else None
    out = []
    for k, (held, tree) in enumerate(trees):
        for at, row in enumerate(held):
            way = path(tree, at) + path(top, k)
            doc_id, *rest, text = row
            changed = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 and text is not None
            node = leaf((doc_id, *rest, text.replace("\n", "") if changed else text))
            for left, right in way:
                node = h("".join([*left, node, *right]))
            siblings = "".join("".join(left + right) for left, right in way)
            out.append((doc_id, tree[0][at], tree[-1][0], top[-1][0], h(siblings), node, node == top[-1][0]))
    return out


def checked(spark, rows, tmp_path):
    docs = spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], SCHEMA).repartition(5)
    folder = str(tmp_path / "in")
    docs.write.parquet(f"{folder}/documents.parquet")
    got = [tuple(r) for r in manifest.op13_merkle_manifest(spark, folder).collect()]
    key = lambda row: tuple((x is not None, x) for x in row)
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    return got


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_manifest_equals_recursion(spark, tmp_path, monkeypatch, levels):
    monkeypatch.setattr(manifest, "LEVELS", levels)
    monkeypatch.setattr(manifest, "SPAN", 3**levels)
    rng = random.Random(levels)
    names = ["hot"] * 20 + [None, "", "é", "z", "Z", "\U0001f600", "￮"]
    rows = [(i, rng.choice(names), rng.choice(["en", None]), i, f"line {i}\nline\n" * rng.randrange(3)) for i in range(150)]
    rows += [(-7, "one", "en", 3, "a\nb"), (400, "two", None, None, None), (401, "two", None, 0, ""), (None, "hot", "en", 2, "x\ny")]
    rows += [(5, "hot", "en", 1, "copy\n")] * 40 + [(5, "hot", "en", 1, "other\n"), (None, None, None, None, None), (None, None, None, None, None)]
    rows += [(402, "long", "de", 9, "words \n" * 100_000)]
    got = checked(spark, rows, tmp_path)
    tampered = {r[0] for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and "\n" in (r[4] or "")}
    assert {r[0] for r in got if not r[-1]} == tampered and len(tampered) > 20


@pytest.mark.parametrize("n", [0, 1, 2, 4])
def test_small_tables(spark, tmp_path, n):
    checked(spark, [(i, "s", "en", 1, "t\n") for i in range(n)], tmp_path)


def test_places_are_those_of_a_plain_log():
    for leaves in [*range(1, 90), 243, 244]:
        for height in {manifest.height_of(leaves), 5}:
            if 3**height < leaves:
                continue
            log = manifest.append_log([i.to_bytes(32) for i in range(leaves)], height)
            level = [i.to_bytes(32) for i in range(leaves)]
            seen = set()
            for k in range(height + 1):
                assert manifest.nodes(log, k, leaves, height) == level
                seen |= set(manifest.places(k, leaves, height).tolist())
                level = [manifest.parent(b"".join(level[i : i + 3])) for i in range(0, len(level), 3)]
            assert seen == set(range(len(log) // 32)) and log[-32:] == manifest.nodes(log, height, leaves, height)[0]


def test_paths_fold_to_the_root_only_with_their_own_leaf():
    leaves = [i.to_bytes(32) for i in range(50)]
    log = manifest.append_log(leaves, 4)
    for i, way in enumerate(manifest.local_paths(log, 50, 4, b"")):
        assert manifest.fold(leaves[i], way) == log[-32:] != manifest.fold(leaves[i - 1], way)
