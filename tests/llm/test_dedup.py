import hashlib
import re
import sys

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from evalspark.llm import exact_dedup, repeats, similar, simhash, substring_dedup, suffix_dedup
from evalspark.llm.components import components
from evalspark.llm.texts import texts_of


def digest(row):
    return hashlib.sha256(bytes(row.kept)).hexdigest()


def removed(row):
    return sum(s.end - s.start for s in row.spans)


def suffix_rows(df, length):
    got = suffix_dedup.suffix_dedup(df, length).collect()
    return {r.doc_id: (r.n_tokens, removed(r), len(r.spans), digest(r)) for r in got}


def substring_rows(df, length):
    got = substring_dedup.substring_dedup(df, length).collect()
    return {r.doc_id: (r.n_tokens, removed(r), digest(r)) for r in got}


@pytest.fixture(params=[256, 1 << 22])
def block(request, monkeypatch):
    """Many small blocks, and one."""
    monkeypatch.setattr(repeats, "BLOCK_BYTES", request.param)


def test_suffix_dedup(frame, small, block):
    assert suffix_rows(frame(small), 50) == brute.suffix_dedup(small, 50)


def test_substring_dedup(frame, small, block):
    assert substring_rows(frame(small), 20) == brute.substring_dedup(small, 20)


def test_few_lots_and_hot_anchors(frame, small, monkeypatch):
    """Blocks share buckets and lots, lots are solved part by part, and pieces of hot anchors are cut."""
    for name, value in (("BLOCK_BYTES", 256), ("BUCKETS", 2), ("SOLVE_BYTES", 2000), ("HOT", 3)):
        monkeypatch.setattr(repeats, name, value)
    assert suffix_rows(frame(small), 50) == brute.suffix_dedup(small, 50)
    assert substring_rows(frame(small), 20) == brute.substring_dedup(small, 20)


def test_rows_and_hot_anchors_stay_small():
    """Rows of a block of documents stop growing with the blocks; so do the distinct pieces that meet
    because of one passage in many surroundings."""
    assert [repeats.bucket_count(n) for n in (13, 412, 5000)] == [13, 268, 412]
    rng = np.random.default_rng(0)
    rule = repeats.Rule(50, suffix_dedup.GRAM, suffix_dedup._tokens, suffix_dedup._grams, False, None, None)
    most = []
    for n in (2000, 8000):
        around = rng.choice(np.frombuffer(b"acgt", np.uint8), (n, 80))
        passage = np.tile(np.frombuffer(bytes(range(128, 188)), np.uint8), (n, 1))
        texts = pa.array([x.tobytes() for x in np.concatenate((around[:, :40], passage, around[:, 40:]), 1)])
        _, start, where, size, anchor, tokens, _ = repeats.runs(rule, texts_of(texts))
        kinds, counts = np.unique(anchor, return_counts=True)
        hot = np.isin(anchor, kinds[counts >= n // 2])
        piece, begin, length, shared = repeats.cut(rule, start[hot], where[hot], size[hot], tokens)
        assert length.max() <= 50 + repeats.CUT - 1 and (length - 49).sum() == (size[hot] - 49).sum()
        found = {}
        for h, a, k in zip(shared.tolist(), begin.tolist(), length.tolist()):
            found.setdefault(h, set()).add(tokens[a : a + k].tobytes())
        most.append(max(len(x) for x in found.values()))
    assert most[1] <= 4**3 * repeats.CUT, most


def test_given_documents(documents, rows):
    assert suffix_rows(documents, 50) == brute.suffix_dedup(rows, 50)
    assert substring_rows(documents, 20) == brute.substring_dedup(rows, 20)


def test_interval_expansion_finds_all_groups():
    rng = np.random.default_rng(0)
    for top, length in ((2, 5), (4, 3), (200, 2)):
        values = np.concatenate([np.append(rng.integers(1, top + 1, k), 0) for k in (80, 3, 40, 1)]).astype(np.int16)
        order, start = suffix_dedup.shared_starts(values, length)
        text = values.tolist()
        group = np.cumsum(start)
        seen = {}
        for place, i in enumerate(order):
            window = tuple(text[i : i + length])
            if len(window) == length and 0 not in window:
                assert seen.setdefault(window, group[place]) == group[place]
        assert len(set(seen.values())) == len(seen)


def test_repeat_edge_rows(frame):
    passage = " ".join(f"p{i}" for i in range(40))
    df = frame([(1, passage), (1, passage), (None, passage), (2, passage + " end"), (3, None)])
    got = sorted(suffix_dedup.suffix_dedup(df).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert [(r.doc_id, removed(r)) for r in got] == [(1, 0), (1, 0), (2, len(passage)), (3, 0), (None, len(passage))]
    got = substring_dedup.substring_dedup(df).collect()
    # Rows of one doc_id are parts of one document: the second copy goes.
    assert sorted((r.doc_id or 9, removed(r)) for r in got) == [(1, 0), (1, 40), (2, 40), (3, 0), (9, 40)]


def test_repeat_same_id_other_text(frame):
    passage = " ".join(f"p{i}" for i in range(30))
    df = frame([(0, passage), (5, passage + " tail"), (5, "head of another text")])
    got = {bytes(r.kept).decode() for r in substring_dedup.substring_dedup(df).collect()}
    assert got == {passage, "tail", "head of another text"}


def test_empty_tables(frame, spark, tmp_path):
    none = frame([])
    for op in (suffix_dedup.suffix_dedup, substring_dedup.substring_dedup, simhash.simhash_groups):
        assert op(none).count() == 0
    none.write.parquet(f"{tmp_path}/none")
    assert exact_dedup.exact_dedup(spark, f"{tmp_path}/none").count() == 0


def test_clashing_columns(frame):
    df = frame([(1, "a b c", "x", 1)], "doc_id bigint, text string, spans string, block int")
    assert suffix_dedup.suffix_dedup(df).count() == 1
    assert simhash.simhash_groups(df).count() == 1
    assert simhash.without_near_duplicates(df).columns == df.columns


def exact_rows(spark, path, **options):
    got = exact_dedup.exact_dedup(spark, path, **options).collect()
    return {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got}


def test_exact_dedup(spark, frame, small, tmp_path):
    frame(small).write.parquet(f"{tmp_path}/docs")
    # One byte a batch: every file is a batch of its own, so the state is met again.
    assert exact_rows(spark, f"{tmp_path}/docs", batch=1) == brute.exact(small)


def test_exact_dedup_goes_on(spark, frame, small, tmp_path):
    docs, folder = f"{tmp_path}/docs", f"{tmp_path}/state"
    frame(small[:30]).write.parquet(docs)
    assert exact_rows(spark, docs, folder=folder) == brute.exact(small[:30])
    frame(small[30:]).write.mode("append").parquet(docs)
    assert exact_rows(spark, docs, folder=folder) == brute.exact(small)


def test_exact_dedup_edges(spark, frame, tmp_path):
    df = frame([(7, "ab"), (7, "ab"), (None, "a  b"), (3, ""), (4, None)], parts=1)
    df.write.parquet(f"{tmp_path}/docs")
    got = exact_dedup.exact_dedup(spark, f"{tmp_path}/docs").collect()
    assert len(got) == 5
    pair = [r for r in got if r.group_size == 3]
    assert {r.keep_id for r in pair} == {None} and sum(r.kept for r in pair) == 1
    assert {(r.doc_id, r.keep_id, r.kept) for r in got if r.group_size == 2} == {(3, 3, True), (4, 3, False)}


def test_exact_dedup_tells_collisions_apart(spark, frame, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: F.substring(F.hex(F.xxhash64(c)), 1, 1))
    rows = [(i, f"text {i // 2}") for i in range(80)]
    frame(rows).write.parquet(f"{tmp_path}/docs")
    got = exact_rows(spark, f"{tmp_path}/docs")
    assert {d: v[:3] for d, v in got.items()} == {d: v[:3] for d, v in brute.exact(rows).items()}


def groups(df):
    got = simhash.simhash_groups(df).collect()
    return {r.doc_id: (r.fingerprint % 2**64, r.component_id) for r in got}


def test_simhash(frame, small):
    prints = brute.fingerprints(small)
    least = brute.linked(prints)
    assert groups(frame(small)) == {d: (prints[d], least[d]) for d in prints}


def test_simhash_given_documents(documents, rows):
    prints = brute.fingerprints(rows)
    least = brute.linked(prints)
    assert groups(documents) == {d: (prints[d], least[d]) for d in prints}
    stay = {r.doc_id for r in simhash.without_near_duplicates(documents).collect()}
    assert stay == set(least.values())


def test_ball_hashing_links_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.integers(-(2**62), 2**62, 12)
    prints = {}
    for i in range(400):
        p = int(base[i % 12])
        for b in rng.integers(0, 64, int(rng.integers(0, 4))):
            p ^= 1 << int(b)
        prints[i] = p % 2**64
    signed = [(i, int(np.uint64(p).astype(np.int64))) for i, p in prints.items()]
    fixed = spark.createDataFrame(signed, "doc_id bigint, fingerprint bigint")
    monkeypatch.setattr(simhash, "materialise", lambda df, name: fixed if name == "fingerprints" else df)
    docs = spark.createDataFrame([(1, "x")], "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in simhash.simhash_groups(docs).collect()}
    assert got == brute.linked(prints)


def test_simhash_null_ids(frame):
    got = simhash.simhash_groups(frame([(None, "a b c d"), (4, "a b c d"), (None, "other text here")])).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (0, 4), (4, 4)]


def by_similarity(rows, words=5, bound=0.8):
    """Component (least position) of each row, from all pairs."""
    sets = []
    for _, text in rows:
        w = re.findall(brute.WORD, brute.lowered(text))
        sets.append({" ".join(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set())
    own = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a == sets[j] or (a and len(a & sets[j]) >= bound * len(a | sets[j])):
                x, y = own[i], own[j]
                own = [min(x, y) if c in (x, y) else c for c in own]
    return own


def test_near_duplicates_by_similarity(documents, rows, frame):
    edited = [t.split() for _, t in rows if t and len(t.split()) > 60][:40]
    more = [(1000 + i, " ".join([*w[: len(w) // 2], "another", *w[len(w) // 2 :]])) for i, w in enumerate(edited)]
    given = sorted([*rows, *more, (2000, " \n"), (2001, None), (2002, "One two"), (2003, "one  TWO"), (2004, "one")])
    own = by_similarity(given)
    want = {given[c][0] for c in own}
    assert len(want) < len(set(brute.linked(brute.fingerprints(given)).values()))  # 2 bits find less
    df = frame(given)
    got = [r.doc_id for r in simhash.without_near_duplicates(df, words=5, similarity=0.8).collect()]
    assert sorted(got) == sorted(want)


def test_near_duplicates_of_a_key_with_several_components(frame):
    rng = np.random.default_rng(6)
    base = [f"w{i}" for i in range(200)]
    given = []
    for i in range(120):  # chains: each text differs a little from one before it
        w = list(base if i < 3 else given[int(rng.integers(0, i))][1].split())
        for at in rng.integers(0, 200, int(rng.integers(2, 8))):
            w[at] = f"x{rng.integers(0, 10**6)}"
        given.append((i, " ".join(w)))
    want = {given[c][0] for c in by_similarity(given)}
    got = [r.doc_id for r in simhash.without_near_duplicates(frame(given), words=5, similarity=0.8).collect()]
    assert len(want) > 1 and sorted(got) == sorted(want)


def counted(monkeypatch, *names):
    """Rows of the tables of these names that `similar` stores from now on."""
    out, held = [], similar.materialise

    def store(df, name):
        df = held(df, name)
        if name in names:
            out.append(df.count())
        return df

    monkeypatch.setattr(similar, "materialise", store)
    return out


@pytest.mark.parametrize("least", [0, 2])
def test_near_copies_of_one_text_are_not_all_paired(frame, monkeypatch, least):
    rng = np.random.default_rng(9)
    base, given = [f"w{i}" for i in range(300)], []
    for i in range(240):  # pairs of at most 6 edits in all are similar enough
        w = list(base)
        for at in rng.choice(300, int(rng.integers(least, 8)), replace=False):
            w[at] = f"x{i}-{at}"
        given.append((i, " ".join(w)))
    tested = counted(monkeypatch, "middle", "pairs")
    got = [r.doc_id for r in simhash.without_near_duplicates(frame(given), words=5, similarity=0.8).collect()]
    assert sorted(got) == sorted({given[c][0] for c in by_similarity(given)})
    assert sum(tested[1:]) < 5 * 240  # 28,680 pairs in all


def test_near_duplicates_by_fingerprints_without_bands(frame, monkeypatch):
    held = similar.materialise
    none = F.array().cast("array<bigint>")
    monkeypatch.setattr(similar, "materialise", lambda df, name: held(df.withColumn("bands", none) if name == "sketches" else df, name))
    w = [f"w{i}" for i in range(6000)]
    given = [(1, " ".join(w)), (2, " ".join([*w[:3000], "other", *w[3001:]])), (3, " ".join(f"v{i}" for i in range(300)))]
    got = [r.doc_id for r in simhash.without_near_duplicates(frame(given), words=5, similarity=0.8).collect()]
    assert sorted(got) == [1, 3]


def test_parities_never_differ_in_more_than_the_sets():
    rng = np.random.default_rng(3)
    for n in (0, 1, 40, 3000):
        a, b = (rng.integers(0, 1 << 63, n, np.uint64) for _ in range(2))
        a[: n // 2] = b[: n // 2]
        differ = np.bitwise_count((similar._parities(a) ^ similar._parities(b)).view(np.uint64)).sum()
        assert differ <= len(np.setxor1d(a, b)) and (n != 40 or differ > 30)


@pytest.mark.parametrize("options", [{}, {"words": 5, "similarity": 0.8}])
def test_near_duplicates_drop_rows_not_ids(frame, options):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    c = " ".join(f"c{i}" for i in range(30))
    df = frame([(5, a), (7, a), (3, b), (5, b), (3, b), (None, a), (None, c), (None, c)])
    got = simhash.without_near_duplicates(df, **options).collect()
    assert sorted(((r.doc_id or 0, r.text) for r in got)) == [(0, c), (3, b), (5, a)]


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (5, 5)], "a bigint, b bigint")
    got = {r.node: r.component for r in components(links, "a", "b").collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}


@pytest.fixture
def many_partitions(spark):
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    for k, v in zip(held, ("24", "false")):
        spark.conf.set(k, v)
    yield
    for k, v in held.items():
        spark.conf.set(k, v)


def test_small_tables_of_near_duplicates_are_written_in_few_files(spark, frame, monkeypatch, many_partitions):
    written = []
    for module in (similar, sys.modules[components.__module__]):
        held = module.materialise
        monkeypatch.setattr(module, "materialise", lambda df, name, held=held: (lambda t: written.append((name, len(t.inputFiles()))) or t)(held(df, name)))
    given = [(i, " ".join(f"g{i // 4}-{k}" for k in range(60)) + f" end{i}") for i in range(120)]
    got = {r.row: r.component for r in similar.similar_groups(frame(given), "doc_id", "text").collect()}
    assert got == {i: i // 4 * 4 for i in range(120)}
    most = {name: max(n for x, n in written if x == name) for name, _ in written}
    assert {most[x] for x in ("classes", "met", "prints", "pairs", "candidates", "links", "components", "open", "common", "prefixes")} == {1}


def test_texts_of_one_template_do_not_meet(frame, monkeypatch):
    rng = np.random.default_rng(8)
    words = [f"t{i}" for i in range(120)]
    given = []
    for i in range(150):  # 120 words in common, 50 of each one's own: similarity below 0.8
        own = [f"x{i}-{k}" for k in range(50)]
        at = sorted(rng.choice(120, 5, replace=False))
        w = list(words)
        for k, a in enumerate(reversed(at)):
            w[a:a] = own[k * 10 : k * 10 + 10]
        given.append((i, " ".join(w)))
    tested = []
    held = similar.materialise
    monkeypatch.setattr(similar, "materialise", lambda df, name: (lambda t: tested.append(t.count()) or t if name == "pairs" else t)(held(df, name)))
    got = simhash.without_near_duplicates(frame(given), words=5, similarity=0.8).count()
    assert got == len({c for c in by_similarity(given)})
    # 11,175 pairs in all: only those with the least text of a key are compared.
    assert len(tested) == 2 and tested[0] < 150 * similar.BANDS and tested[1] == 0
