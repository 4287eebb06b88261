"""Line dedup, collocation mining and importance resampling against plain versions."""

import random

import brute
import numpy as np
import pytest

from evalspark.llm import collocations, line_dedup, resample

CLASHES = ", row string, doc string, d1 string, body string, lines int, dropped int, words int, key int, n int, part int, at int"


def lined(seed, n=80):
    """Documents of lines, some shared, in several spellings; one line in most documents."""
    rng = random.Random(seed)
    pool = [f"shared line number {i} of all" for i in range(15)] + ["short", "  ", "", "ÄÖÜ äöü ñ", "naïve café"]

    def line():
        x = rng.choice(pool) if rng.random() < 0.6 else f"own {rng.random()}"
        return rng.choice(["", " ", "\t\r"]) + rng.choice([x, x.upper(), x.title()]) + rng.choice(["", "  ", "\x0b\x0c\r"])

    rows = [(1, None), (2, ""), (3, "\n\n"), (None, "Shared line number 1 of all"), (None, "Shared line number 1 of all")]
    for i in range(n):
        body = [line() for _ in range(rng.randint(1, 150 if i % 20 == 0 else 8))]
        if i % 3:
            body.insert(rng.randint(0, len(body)), "All rights reserved everywhere")
        rows.append((rng.choice([i, i, i // 2 + 100]), "\n".join(body)))
    return rows


@pytest.mark.parametrize("sample,met", [(1 << 21, 16), (1 << 21, 1), (64, 2)])
def test_line_dedup(frame, sample, met, monkeypatch):
    monkeypatch.setattr(line_dedup, "SAMPLE", sample)
    monkeypatch.setattr(line_dedup, "MET", met)
    for seed in (1, 2):
        rows = lined(seed)
        got = line_dedup.line_dedup(frame(rows)).collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute.line_dedup(rows)))
        assert sum(r.n_dropped for r in got) > 20


def test_line_dedup_parts_of_hot_lines(frame, monkeypatch):
    monkeypatch.setattr(line_dedup, "MET", 2)
    rows = [(i, "the very same line\nand one of my own %d" % i) for i in range(300)] + [(-5, "The very same line")]
    lines = line_dedup.line_keys(frame(rows), "doc_id", "text", 10)
    lines = lines.withColumn("row", line_dedup.F.monotonically_increasing_id())
    salts = [r.salts for r in line_dedup._salts(lines, line_dedup.F.col("row")).collect()]
    assert len(salts) == 1 and salts[0] > 1
    got = {r.doc_id: r.n_dropped for r in line_dedup.line_dedup(frame(rows)).collect()}
    assert got == {i: int(i >= 0) for i in got}


def test_line_dedup_edges(frame, spark):
    assert line_dedup.line_dedup(frame([])).count() == 0
    long = "\n".join(f"line number {i % 50_000}" for i in range(100_000))
    got = {r.doc_id: r for r in line_dedup.line_dedup(frame([(1, long), (2, long + "\nmy own last line")])).collect()}
    assert (got[1].n_dropped, got[1].kept) == (0, long)
    assert (got[2].n_lines, got[2].n_dropped, got[2].kept) == (100_001, 100_000, "my own last line")
    values = ("r", "d", "e", "b", 1, 2, 3, 4, 5, 6, 7)
    clash = spark.createDataFrame([(1, "a shared line", *values), (2, "x\nA shared line", *values), (3, None, *values)], "doc_id bigint, text string" + CLASHES)
    kept = line_dedup.without_repeated_lines(clash).collect()
    assert sorted(map(tuple, kept)) == [(1, "a shared line", *values), (2, "x", *values), (3, None, *values)]


def worded(seed, n=120):
    """(lang, text): phrases that recur, fixed ones among them, over breaks and gaps of all kinds."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)] + ["Ünd", "日本"]
    fixed = ["new york city hall", "red tape", "one fine day"]
    rows = [("en", None), (None, ""), ("de", " \t\n"), ("en", ".,;:!?")]
    for _ in range(n):
        words = [rng.choice(vocabulary) if rng.random() < 0.8 else rng.choice(fixed) for _ in range(rng.randint(1, 60))]
        text = "".join(w + rng.choice([" ", " ", "\t", "  ", ". ", "\n", ",", " ; "]) for w in words)
        rows.append((rng.choice(["en", "en", "de", None]), text.title() if rng.random() < 0.3 else text))
    return rows


def found(df, **options):
    return sorted(map(tuple, collocations.collocations(df, **{"slot_bits": 16, **options}).collect()))


@pytest.mark.parametrize("shards,bits,step", [(2, 22, 1 << 18), (3, 15, 7), (1, 22, 50)])
def test_collocations(frame, shards, bits, step):
    rows = worded(3)
    got = found(frame(rows, "lang string, text string"), shards=shards, least=15, slot_bits=bits, step_words=step)
    assert got == sorted(brute.collocations(rows, least=15))
    assert {len(r[2].split()) for r in got} == {2, 3, 4} and {r[0] for r in got} == {"en", "de", "und"}


def test_collocations_limit_and_repeats(frame):
    rows = worded(4, 60) * 2
    df = frame(rows, "lang string, text string")
    assert found(df, shards=2, least=20, most=5, longest=3) == sorted(brute.collocations(rows, 3, 20, 5))


def test_phrases_start_after_their_parts_and_are_counted_in_full(spark):
    # One document per shard in turn: "a b" reaches 30 only in the last shard of the first cycle.
    rows = [("en", "a b c d . " * (10 if i else 0)) for i in range(4)]
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    counts = {r.phrase: r.n for r in collocations.phrase_counts(df, shards=4).collect()}
    assert counts == {"": 120, **{p: 30 for p in ("a", "b", "c", "d", "a b", "b c", "c d", "a b c", "b c d", "a b c d")}}


def test_phrases_that_share_a_key_are_counted_anew(frame, monkeypatch):
    answers = iter([True, False])
    monkeypatch.setattr(collocations, "_shared", lambda known: next(answers))
    rows = worded(5, 40)
    assert found(frame(rows, "lang string, text string"), shards=1) == sorted(brute.collocations(rows))
    assert next(answers, None) is None


def test_collocations_edges(frame, spark):
    assert found(frame([], "lang string, text string")) == []
    clash = spark.createDataFrame([("en", "a b " * 40, 1, 2, 3, "x")], "lang string, text string, shard int, key int, n int, rank string")
    assert found(clash) == sorted(brute.collocations([("en", "a b " * 40)]))
    long = [("en", "x y z, " * 60_000), ("en", "one " * 300_000)]  # more words than a step holds
    assert found(frame(long, "lang string, text string")) == sorted(brute.collocations(long))


def scores(df, target, spark, **options):
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    return sorted(map(repr, map(tuple, resample.importance(df, bench, **options).collect())))


@pytest.mark.parametrize("longest", [1, 3])
def test_importance(frame, small, spark, longest):
    target = ["w1 w2 w3", None, "The the THE ñandú", "w5 " * 30]
    options = dict(longest=longest, buckets=101, percent=35)
    rows = [*small, (None, "w1 w2 " * 20), (3, "w7 " * 25)]
    want = brute.importance(rows, target, least=20, **options)
    assert scores(frame(rows), target, spark, **options) == sorted(map(repr, want))
    assert any(x[5] for x in want)


def test_importance_edges(frame, small, spark):
    assert scores(frame([]), ["a"], spark) == []
    rows = [(1, None), (2, ""), (2, "w " * 25), (2, "w " * 25)]
    assert scores(frame(rows), [], spark, percent=50) == sorted(map(repr, brute.importance(rows, [], 50)))
    bench = spark.createDataFrame([("w1 w2",)], "text string")
    ddl = "doc_id bigint, text string, score int, weight int, part int, row string"
    clash = spark.createDataFrame([(d, t, 1, 2, 3, "r") for d, t in small], ddl)
    drawn = {x[0] for x in brute.importance(small, ["w1 w2"], 40) if x[5]}
    got = resample.resampled(clash, bench, percent=40).collect()
    assert sorted(tuple(r) for r in got) == sorted((d, t, 1, 2, 3, "r") for d, t in small if d in drawn)
    assert resample.resampled(clash.where("doc_id < 0"), bench).count() == 0


def test_runs_do_not_cross_documents():
    steps = list(resample.features([b"a b", b"", b"c", b"D e"], 2, 1 << 32))
    crc = resample.crc32
    pairs = [(int(o), int(c)) for owner, code, n in steps if n == 2 for o, c in zip(owner, code)]
    assert pairs == [(0, crc(b"a b")), (3, crc(b"d e"))]
    assert np.concatenate([o for o, _, n in steps if n == 1]).tolist() == [0, 0, 2, 3, 3]


@pytest.mark.parametrize("step", [1, 2, 5])
def test_steps_hold_whole_runs(step):
    rng = random.Random(step)
    texts = [" ".join(rng.choice("abcde") for _ in range(rng.randint(0, 12))).encode() for _ in range(30)]

    def runs(size):
        return sorted((int(o), int(c), n) for owner, code, n in resample.features(texts, 3, 1 << 32, size) for o, c in zip(owner, code))

    assert runs(step) == runs(1 << 17)
