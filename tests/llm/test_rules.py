"""Quality rules against brute force: base counts, both multinomials, weights and verdicts."""

import math
import random
import re
from collections import Counter

import pytest
import regex
import xxhash

from memberlytics.llm import rules

SCHEMA = "doc_id bigint, text string, lang string, quality int, weights string, score string"
LABELS = "doc_id bigint, quality int, toxic int, text string"


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def base(text):
    text = text or ""
    found = words(text)
    windows = [tuple(found[i : i + 8]) for i in range(len(found) - 7)]
    times = Counter(windows)
    repeated = {i + k for i, window in enumerate(windows) if times[window] > 1 for k in range(8)}
    lines = [line for line in text.split("\n") if words(line)]
    failed = len(found) < 20 or 100 * len(repeated) > 30 * len(found)
    return (
        len(found), sum(map(len, found)), sum(text.count(s) for s in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated), failed,
    )


def xxh(data, seed=42):
    return xxhash.xxh64_intdigest(data, seed)


def grams(text):
    hashes = [xxh(t.encode()) for t in regex.findall(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]+", (text or "").lower())]
    pairs = [xxh(b.to_bytes(8, "little"), xxh(a.to_bytes(8, "little"))) for a, b in zip(hashes, hashes[1:])]
    return [h % rules.BUCKETS for h in hashes + pairs]


def brute(rows, labels):
    trusted = {i for i, quality, *_ in labels if quality == 1 and i is not None}
    raw, target = Counter(), Counter()
    for doc_id, text in rows:
        raw.update(grams(text))
        if doc_id in trusted:
            target.update(grams(text))
    raws, targets, n = sum(raw.values()), sum(target.values()), rules.BUCKETS
    weight = {b: round(1e6 * (math.log((target[b] + 1) / (targets + n)) - math.log((raw[b] + 1) / (raws + n)))) if targets else 0 for b in raw}
    out = []
    for doc_id, text in rows:
        held, counted = grams(text), base(text)
        score = sum(weight[b] for b in held) / len(held) if held else None
        out.append((doc_id, *counted, not counted[-1] and score is not None and score >= -300_000, score))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocabulary = [f"Wort{i}" for i in range(300)] + ["été", "ñandú", "don't", "3.5"]
    prose = [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 150))) for _ in range(60)]
    junk = [" | ".join(rng.choices(vocabulary, k=60)) for _ in range(8)] + [" ".join(w + "%%%" for w in rng.choices(vocabulary, k=80)) for _ in range(8)]
    loop = " ".join(rng.choices(vocabulary, k=11))
    odd = [
        None, "", " \n\t ", "\x85 \x85", "a\x00b <|>", "one\n\none\n one\none", "same " * 500, f"{loop} " * 9, f"{prose[0]} {loop} x {loop}",
        " ".join(rng.choices(vocabulary, k=20_000)), "ab " * 30_000, "x" * 100_000, "\U0001f600 　 ß " * 12, "one\r\ntwo\r\none\r\n",
        " ".join(str(i) for i in range(19)), " ".join(str(i) for i in range(20)), " ".join(str(i % 15) for i in range(22)),
    ]
    out = list(enumerate([*prose, *junk, *odd]))
    return [*out, (1, prose[1]), (1, prose[1]), (3, junk[0]), (None, prose[3]), (None, None)]


def checked(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, "en", 0, "w", "s") for i, t in rows], SCHEMA).repartition(3)
    got = rules.judge(docs, spark.createDataFrame(labels, LABELS))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"]
    key = lambda row: tuple((x is not None, x) for x in row[:-1])
    got, expected = sorted(map(tuple, got.select(*columns).collect()), key=key), sorted(brute(rows, labels), key=key)
    assert [r[:-1] for r in got] == [r[:-1] for r in expected]
    for (*_, a), (*_, b) in zip(got, expected, strict=True):
        assert a == b or a == pytest.approx(b / 1e6, abs=2e-6)
    return got


def test_rules_equal_brute_force(spark, rows):
    labels = [(i, int(i < 60), 0, "clash") for i in range(0, 76, 2)] + [(0, 1, 1, "twice"), (0, 0, 0, "twice"), (None, 1, 0, ""), (4, None, None, None), (9999, 1, 0, "")]
    got = checked(spark, rows, labels)
    verdict = {r[0]: r[7] for r in got if r[0] is not None}
    long_enough = [i for i, text in rows[:60] if not base(text)[-1] and i != 3]
    assert all(verdict[i] for i in long_enough) and not any(verdict[i] for i in range(60, 76))


def test_without_trusted_documents_and_without_documents(spark, rows):
    got = checked(spark, rows[:70], [(3, 0, 0, "")])
    assert all(r[-1] in (0.0, None) for r in got) and any(r[7] for r in got)
    assert checked(spark, [], [(3, 1, 0, "")]) == []


def test_very_long_text_in_the_time_of_a_sort(spark):
    text = " ".join(f"w{i % 150_000}" for i in range(300_000)) + "\nline" * 100_000
    row = rules.base_counts(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).drop("text").first()
    # All of the 400,000 words repeat, but for the first of each stretch that meets another neighbour.
    assert tuple(row)[:5] == (1, 400_000, sum(len(w) for w in words(text)), 0, 99_999) and row.n_repeat_words == base(text)[4]


def test_query_keeps_clean_documents_and_drops_junk(spark, sf_dir):
    from memberlytics.llm.rules import op12_quality_rules

    got = op12_quality_rules(spark, sf_dir)
    assert got.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    judged = {r.doc_id: r for r in got.collect()}
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    sound = [r for i, r in judged.items() if quality.get(i) == 1 and not r.base_failed]
    poor = [r for i, r in judged.items() if quality.get(i) == 0]
    assert sum(r.kept for r in sound) >= 0.99 * len(sound) and sum(r.kept for r in poor) <= 0.05 * len(poor)
