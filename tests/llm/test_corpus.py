import hashlib
import re
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest

from evalspark.llm import decontaminate, mixing, quality, sharding, url_filter, warc
from evalspark.llm.queries import URL_RULES
from test_dedup import by_similarity

DOC = "doc_id bigint, text string"
SOURCED = "doc_id bigint, source string, text string"


# Sharding


def size(text):
    return len((text or "").encode()) + 16


def shards_of(rows, shards):
    """(doc_id, size, checksum, shard, slot) of each row."""
    total, start, slots, out = sum(size(t) for _, t in rows), 0, Counter(), []
    key = lambda r: (r[0] is not None, r[0] or 0, size(r[1]), zlib.crc32((r[1] or "").encode()))
    for d, t in sorted(rows, key=key):
        s = (2 * start + size(t)) * shards // (2 * total)
        start += size(t)
        out.append((d, size(t), zlib.crc32((t or "").encode()), s, slots[s]))
        slots[s] += 1
    return sorted(out, key=repr)


def sharded(df, shards):
    got = sharding.shard_by_bytes(df, shards).collect()
    return sorted(((r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in got), key=repr)


@pytest.mark.parametrize("chunk", [3, 1024])
@pytest.mark.parametrize("shards", [1, 7, 40])
def test_sharding(frame, small, shards, chunk, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK_ROWS", chunk)
    assert sharded(frame(small), shards) == shards_of(small, shards)


def test_sharding_edges(frame, spark):
    rows = [(None, "a"), (5, "long " * 300), (5, "x"), (5, "x"), (6, None)]
    assert sharded(frame(rows), 4) == shards_of(rows, 4)
    assert sharding.shard_by_bytes(frame([]), 4).count() == 0
    clash = spark.createDataFrame([(1, "a", 9, "s")], DOC + ", slot int, shard string")
    assert sharding.shard_by_bytes(clash, 2).columns == ["doc_id", "text", "size", "text_crc32", "shard", "slot"]


# WARC


def test_warc_round_trip(spark):
    big, bigger = "é" * 600, "<p>x</p>" * 20_000
    rows = [(1, "http://a/", big), (2, "http://b/\r\nX: y", big), (3, None, bigger), (9, "http://d/", big)]
    rows += [(4, "http://c/", "small"), (5, "", "small"), (6, "http://e/", None), (7, "http://f/", ""), (None, "http://g/", bigger)]
    rows += [(8, "http://h/", "a\r\n\r\nb" + "\n" * 999)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    index = warc.write_archives(pages)
    got = {r.page_id: r for r in warc.resolved(warc.read_records(index)).collect()}
    refers = {1: 9, 2: 9, None: 3}
    assert len(got) == len(rows)
    for page, url, html in rows:
        data = (html or "").encode()
        r = got[page]
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        assert (r.record_type, r.refers_to) == ("revisit" if page in refers else "response", refers.get(page))
        assert r.url == (url if url is None else url.replace("\r\n", "%0D%0A"))
    some = warc.read_records(index.where("page_id in (3, 4)")).collect()
    assert {(r.page_id, bytes(r.payload).decode()) for r in some} == {(3, bigger), (4, "small")}


def test_warc_repeats_and_empty(spark):
    ddl = "page_id bigint, url string, html string, digest int, file string"
    text = "x" * 1000
    pages = spark.createDataFrame([(2, "u", text, 1, "f"), (2, "u", text, 1, "f"), (1, "u", text, 1, "f")], ddl)
    got = warc.resolved(warc.read_records(warc.write_archives(pages))).collect()
    assert sorted((r.page_id, r.record_type) for r in got) == [(1, "revisit"), (2, "response"), (2, "response")]
    assert warc.read_records(warc.write_archives(pages.where("page_id = 3"))).count() == 0


def test_ranges_are_joined():
    assert warc.joined_ranges([(0, 10), (10, 5), (15 + warc.GAP_BYTES, 5), (10**9, 1)]) == [
        (0, 20 + warc.GAP_BYTES, [0, 1, 2]),
        (10**9, 1, [3]),
    ]
    one = warc.joined_ranges([(0, warc.RANGE_BYTES * 3), (warc.RANGE_BYTES * 3, 1)])
    assert [x[2] for x in one] == [[0], [1]]


# URL filters


def judged(url, rules):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [r for r in rules if host and (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block")) if fits else None
    return (host, path, best[0] + best[1], best[2]) if best else (host, path, None, "allow")


URLS = [None, "", "no scheme", "http://", "http://COM/", "http://com", "https://x.com/?q", "https://example.com/en/1#x"]
URLS += ["ftp://www.example.com/en/2", "http://a.www.example.com/en/", "http://myexample.com/en/", "http://net/es/", "http://x.net/fr"]
URLS += ["http://x.net/fr/1?http://com/", "://example.com/en/a", "http://example.com\n/en/", "http://example.com-x/en/", "http://a..com/"]
URLS += ["http://ÄX.com/", "http://com.example.com/en/", "http://u@example.com:80/en/", "http://\x00.com/", "http://example.com/en"]


@pytest.mark.parametrize("passes", [1, 2, 100])
def test_url_filter(spark, passes):
    rules = [*URL_RULES, ("a.b.c", "/", "block"), ("b.c", "/long/path/", "allow"), ("c", "", "block"), ("net", "/es/", "allow")]
    urls = URLS + [f"http://{h}/{p}" for h in ("c", "b.c", "a.b.c", "z.a.b.c", "ab.c", "d") for p in ("", "long/path/x", "en/")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").repartition(4)
    for chosen in (URL_RULES, rules):
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, chosen, pass_rules=passes).collect()}
        assert got == {i: judged(u, chosen) for i, u in enumerate(urls)}


def test_url_filter_edges(spark):
    pages = spark.createDataFrame([(1, "http://com/", "x", 1)], "page_id bigint, url string, host string, rule int")
    got = url_filter.filter_urls(pages, [], default="block").collect()
    assert [tuple(r) for r in got] == [(1, "http://com/", "com", "/", None, "block")]
    assert url_filter.filter_urls(pages.where("page_id = 2"), URL_RULES).count() == 0


# Benchmark decontamination

ITEMS = [(1, "w1 w2 w3 w4"), (2, " ".join(f"w{i % 7}" for i in range(30))), (10, "The THE the"), (11, None), (12, "!!"), (None, "w5"), (1, "w1 w2 w3 w4")]


def hits(df, items, spark):
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.find_contamination(df, bench).collect()
    return {r.doc_id: (r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in got}


@pytest.mark.parametrize("shard,passes", [(200, 1 << 20), (1 << 20, 10)])
def test_decontamination(frame, small, spark, shard, passes, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", shard)
    monkeypatch.setattr(decontaminate, "PASS_BYTES", passes)
    taken = [t for _, t in small if t and len(t) < 2000][:8]
    items = ITEMS + [(100 + i, t) for i, t in enumerate(taken)]
    assert hits(frame(small), items, spark) == brute.contamination(small, items)


def test_decontamination_edges(frame, spark):
    assert hits(frame([]), ITEMS, spark) == {}
    assert hits(frame([(1, "w1"), (2, None)]), [], spark) == {1: (1, 0, [], False), 2: (0, 0, [], False)}
    clash = spark.createDataFrame([(1, "w1 w2 w3 w4 w9", 3, "x"), (2, "fine", 3, "y")], DOC + ", n_hit int, items string")
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert [tuple(r) for r in decontaminate.without_contaminated(clash, bench).collect()] == [(2, "fine", 3, "y")]


def test_decontamination_of_a_text_of_several_slices(frame, spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 10_000)
    rows = [(1, " ".join(f"w{i % 911}" for i in range(30_000))), (2, "w5"), (3, None)]
    assert hits(frame(rows), ITEMS, spark) == brute.contamination(rows, ITEMS)


def test_items_without_id(frame, spark):
    """They hit; together they are one item, which the list of ids leaves out."""
    items = [(None, "a b"), (None, "c d"), (7, "c d")]
    rows = [(1, "a b x"), (2, "a b c d"), (3, "x")]
    assert hits(frame(rows), items, spark) == {1: (3, 2, [None], True), 2: (4, 4, ["7", None], True), 3: (1, 0, [], False)}


# Columns of any name


WORKING = ("_row", "_part", "part", "chunk", "begin", "kept_0", "key", "_key", "spread", "rule_size", "body", "_body", "text", "spans2", "row", "at")


def test_columns_of_any_name_are_kept(frame, spark):
    """No working column of an operator meets a column of the caller's."""
    ddl = "doc_id bigint, body string, `a.b` int, " + ", ".join(f"`{c}` string" for c in WORKING if c != "body")
    rows = [(i, f"http://x{i}.com/ w{i} w2 w3", i, *[f"{c} {i}" for c in WORKING if c != "body"]) for i in range(9)]
    docs = spark.createDataFrame(rows, ddl).repartition(3)
    none = quality.fit(docs.where("doc_id < 0"), spark.createDataFrame([], "doc_id bigint, quality int"), text="body")
    bench = spark.createDataFrame([(1, "w2 w3")], "item_id bigint, body string")
    for got in (
        sharding.shard_by_bytes(docs, 3, text="body"),
        url_filter.filter_urls(docs, URL_RULES, url="body"),
        quality.score(docs, none, text="body"),
        decontaminate.find_contamination(docs, bench, text="body"),
    ):
        assert got.columns[: len(docs.columns)] == docs.columns
        assert sorted(tuple(r)[: len(docs.columns)] for r in got.collect()) == rows


def test_index_counts_and_locates():
    rng = np.random.default_rng(5)
    text = np.concatenate([np.append(rng.integers(1, 4, n), 0) for n in (50, 1, 33, 80)])
    index = decontaminate.Index(text, 3)
    for size in range(1, 6):
        phrase = rng.integers(1, 4, (40, 6))
        low, high = index.search(phrase, np.full(40, size))
        for p, a, b in zip(phrase, low, high):
            want = [i for i in range(len(text) - size + 1) if (text[i : i + size] == p[-size:]).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


# Mixing


def test_mix(frame, small, spark):
    rows = [(d, None if d % 11 == 0 else f"s{d % 4}", t) for d, t in small for _ in range(1)]
    for block, words in ((1, 10**9), (8, 500)):
        df = frame(rows, SOURCED)
        got = mixing.mix(df, block=block, shard_words=words).collect()
        again = mixing.mix(df.repartition(5), block=block, shard_words=words).collect()
        assert sorted(map(repr, got)) == sorted(map(repr, again))
        own, taken, cells = Counter(), Counter(), {}
        for r in got:
            n = len(re.findall(brute.WORD, r.text or ""))
            assert r["size"] == n and 0 <= r.taken <= 3 * n
            assert r.taken == r.rounds * n + sum(p.end - p.start for p in r.parts)
            own[r.source] += n
            taken[r.source] += r.taken
            cells[r.source] = (r.source_size, r.target)
        total = sum(own.values())
        names = sorted(own, key=lambda s: (s is None, s or ""))
        want, open_ = {}, dict(zip(names, (1, 2, 3, 1, 2)))
        while open_:  # shares, the excess reshared until none is above
            rest = total - sum(want.values())
            share = {s: rest * w / sum(open_.values()) for s, w in open_.items()}
            over = [s for s in share if share[s] > 3 * own[s]]
            want.update({s: 3 * own[s] for s in over} if over else share)
            open_ = {s: w for s, w in open_.items() if s not in want}
        for s in names:
            assert cells[s] == (own[s], pytest.approx(want[s]))
            shards = max(1, -(-own[s] // words))
            assert abs(taken[s] - want[s]) <= 2 * block * shards + 1


def test_sainte_lague_deals_by_highest_quotient():
    rng = np.random.default_rng(1)
    for _ in range(50):
        claims = rng.integers(0, 200, 6).astype(float)
        most = rng.integers(0, 30, 6)
        seats = int(rng.integers(0, 60))
        quota = np.zeros(6, int)
        for _ in range(seats):
            open_ = (quota < most) & (claims > 0)
            if open_.any():
                quota[np.argmax(np.where(open_, claims / (2 * quota + 1), -1))] += 1
        assert mixing.sainte_lague(claims, seats, most).tolist() == quota.tolist()


def test_mixed_texts(frame, small):
    rows = [(d, f"s{d % 4}", t) for d, t in small]
    df = frame(rows, SOURCED)
    taken = {r.doc_id: r.taken for r in mixing.mix(df, block=8).collect()}
    words = Counter()
    texts = dict(small)
    for r in mixing.mixed(df, block=8).collect():
        found = re.findall(brute.WORD, r.text)
        words[r.doc_id] += len(found)
        whole = iter(re.findall(brute.WORD, texts[r.doc_id]))
        assert all(w in whole for w in found)  # in order
    assert words == Counter({d: n for d, n in taken.items() if n})


def test_mixed_keeps_columns_of_any_name(frame, small, spark):
    extra = "size int, taken string, _copy int, parts string, target double, rounds int, source_size int, shard int, row string, at int"
    rows = [(d, f"s{d % 4}", t, 99, "k", 7, "p", 0.5, 2, 3, 4, "r", 5) for d, t in small]
    plain = mixing.mixed(frame([r[:3] for r in rows], SOURCED), block=8)
    got = mixing.mixed(spark.createDataFrame(rows, SOURCED + ", " + extra).repartition(3), block=8)
    assert got.columns[3:] == ["size", "taken", "_copy", "parts", "target", "rounds", "source_size", "shard", "row", "at"]
    assert {tuple(r)[3:] for r in got.collect()} == {rows[0][3:]}
    assert sorted(tuple(r)[:3] for r in got.collect()) == sorted(map(tuple, plain.collect()))
    renamed = frame([r[:3] for r in rows], "id bigint, origin string, body string")
    got = mixing.mixed(renamed, block=8, doc_id="id", source="origin", text="body")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))


def test_mix_takes_blocks_by_a_seeded_permutation(frame, small):
    """Blocks taken of each shard, from the rounds and parts: a permutation's first `rest` blocks."""
    rows = [(d, "s", t) for d, t in small] + [(d + 10_000, "z", t) for d, t in small[:5]]
    got = mixing.mix(frame(rows, SOURCED), block=4, weights=(1, 1)).collect()
    for name in ("s", "z"):
        own = sorted((r for r in got if r.source == name and r["size"]), key=lambda r: r.doc_id)
        assert len({r.rounds for r in own}) == 1  # one shard, one number of rounds
        total = sum(r["size"] for r in own)
        quota = round(own[0].target / 4)
        blocks = -(-total // 4)
        rest = quota - own[0].rounds * blocks
        assert 0 <= rest < blocks or abs(quota - 3 * blocks) <= 1
        partial = sum(p.end - p.start for r in own for p in r.parts)
        assert 4 * (rest - 2) <= partial <= 4 * (rest + 2)


def test_mix_edges(frame, spark):
    assert mixing.mix(frame([], SOURCED)).count() == 0
    got = mixing.mix(frame([(1, None, None), (1, None, " "), (None, "a", "x y"), (None, "a", "x y")], SOURCED), block=1).collect()
    assert sorted((r.source or "", r["size"], r.taken, r.target) for r in got) == [("", 0, 0, 0.0), ("", 0, 0, 0.0), ("a", 2, 2, 4.0), ("a", 2, 2, 4.0)]
    clash = spark.createDataFrame([(1, "a", "x y", 7, "z")], SOURCED + ", size int, shard string")
    assert mixing.mix(clash).columns[:4] == ["doc_id", "source", "text", "shard"]


# Quality


def test_quality_on_held_out_rows(spark, monkeypatch):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    rows = quality.score(docs.join(labels, "doc_id").where(quality.held_out("doc_id")), model).collect()
    assert len(rows) > 50
    assert np.mean([(r.score >= quality.THRESHOLD) == r.quality for r in rows]) >= 0.9


def test_quality_score_covers_the_whole_text():
    texts, labels = [], []
    rng = np.random.default_rng(0)
    for i in range(300):
        body = " ".join(rng.choice(["alpha", "beta", "gamma", "delta"], 60))
        texts.append((body if i % 2 else body.replace("a ", "a### ")).encode())
        labels.append(i % 2)
    model = quality.train(texts, labels)

    def score(text):
        data = np.frombuffer(text, np.uint8)
        return float(quality.probability(model, *quality.laid_out(data, np.array([0]), np.array([len(data)])))[0])

    assert np.mean([(score(t) >= 0.5) == y for t, y in zip(texts, labels)]) > 0.95
    # Junk at the very end of a long text changes the score.
    assert score(texts[1] * 40) - score(texts[1] * 40 + texts[0] * 20) > 0.05


def test_quality_gradients():
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (0, 10, 700, 3000)]
    size = np.array([len(t) for t in texts])
    cells, first = quality.laid_out(np.frombuffer(b"".join(texts), np.uint8), np.cumsum(size) - size, np.cumsum(size))
    y, w = np.array([0, 1, 1, 0], np.float32), np.ones(4, np.float32)
    model = quality.initial(1)
    for i, x in enumerate(model.parts()):
        model.parts()[i][...] = x
    grads = quality._gradients(model, cells, first, y, w)

    def loss():
        p = quality.probability(model, cells, first)
        return -np.mean(np.where(y > 0, np.log(p), np.log(1 - p)))

    for x, g in zip(model.parts(), grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        held, step = x[at], 1e-3
        x[at] = held + step
        up = loss()
        x[at] = held - step
        down = loss()
        x[at] = held
        assert (up - down) / (2 * step) == pytest.approx(float(g[at]), rel=0.1, abs=1e-3)


def test_quality_scores_do_not_depend_on_neighbours():
    rng = np.random.default_rng(4)
    sizes = [0, 3, 512, 509, 700, 1024, 1, 2000, 256, 4]
    texts = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in sizes]
    model = quality.initial(1)
    model.shift[:] = -0.5

    def scores(some):
        size = np.array([len(t) for t in some], np.int64)
        data = np.frombuffer(b"".join(some), np.uint8)
        return quality.probability(model, *quality.laid_out(data, np.cumsum(size) - size, np.cumsum(size)))

    alone = np.concatenate([scores([t]) for t in texts])
    for _ in range(5):
        order = rng.permutation(len(texts))
        for width in (2, 3, len(texts)):
            got = np.concatenate([scores([texts[i] for i in order[k : k + width]]) for k in range(0, len(texts), width)])
            assert got == pytest.approx(alone[order], abs=1e-6)


def test_quality_edges(frame, spark):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (3, 0), (3, 1)], "doc_id bigint, quality int")
    docs = frame([(1, None), (2, ""), (3, "x"), (None, "y"), (3, "x")])
    got = quality.score(docs, quality.fit(docs, labels)).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    none = quality.fit(docs.where("doc_id < 0"), labels)
    assert quality.score(docs.where("doc_id < 0"), none).count() == 0
    clash = spark.createDataFrame([(1, "a", "z", "q")], DOC + ", score string, label string")
    assert quality.score(clash, none).columns == ["doc_id", "text", "label", "score"]


# The pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id % 2 = 0")
    columns = docs.columns
    model = quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    scores = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    held = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, sf).cache()
        assert docs.columns == columns
        held[name] = [(r.doc_id, r.text) for r in docs.collect()]
        if name == "mixing sources":
            break
        old = [(r.doc_id, r.text) for r in before.collect()]
        if name == "quality classifier":
            want = {d for d, _ in old if scores[d] >= quality.THRESHOLD}
        elif name == "near-dedup":
            old.sort()
            want = {old[c][0] for c in by_similarity(old)}
        else:
            bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            want = {d for d, v in brute.contamination(old, bench).items() if not v[3]}
        assert held[name] == [(d, t) for d, t in held[name]] and {d for d, _ in held[name]} == want
        assert set(held[name]) <= set(old)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    slots = defaultdict(list)
    for r in last:
        slots[r.shard].append(r.slot)
    assert sorted((r.doc_id, r.text) for r in last) == sorted(held["mixing sources"])
    assert set(slots) <= set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
