"""Plain versions of the operators, straight from their rules."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def suffix_dedup(rows, length):
    """doc_id -> (bytes, removed, spans, digest of the rest)."""
    first, out = {}, {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            first.setdefault(b[i : i + length], d)
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < d:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, y in zip(b, gone) if not y)
        out[d] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def substring_dedup(rows, length):
    """doc_id -> (words, removed, digest of the rest)."""
    words = {d: re.findall(WORD, t or "") for d, t in rows}
    seen, out = {}, {}
    for d in sorted(words):
        for i in range(len(words[d]) - length + 1):
            seen.setdefault(tuple(words[d][i : i + length]), (d, i))
    for d, w in words.items():
        gone = [0] * len(w)
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] < (d, i):
                gone[i : i + length] = [1] * length
        kept = " ".join(x for x, y in zip(w, gone) if not y)
        out[d] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def contamination(rows, items, length=13):
    """doc_id -> (words, hit, items, contaminated)."""

    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))

    windows, out = defaultdict(set), {}
    for name, text in items:
        w = words(text)
        for k in range(max(1, len(w) - length + 1)) if w else ():
            windows[tuple(w[k : k + length])].add(name if name is None else str(name))
    sizes = {len(k) for k in windows}
    for d, text in rows:
        w = words(text)
        hit, found = [0] * len(w), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if x := windows.get(tuple(w[k : k + size])):
                    hit[k : k + size] = [1] * size
                    found |= x
        out[d] = (len(w), sum(hit), sorted(found, key=lambda x: (x is None, x or "")), sum(hit) > 0 and 20 * sum(hit) >= len(w))
    return out


def fingerprints(rows, size=3):
    out = {}
    for d, text in rows:
        w = re.findall(WORD, lowered(text))
        shingles = [" ".join(w[k : k + size]) for k in range(max(1, len(w) - size + 1))] if w else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        out[d] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    return out


def linked(prints, radius=2):
    """doc_id -> smallest doc_id reachable."""
    ids, least = sorted(prints), {}
    for d in ids:
        if d in least:
            continue
        least[d], queue = d, [d]
        while queue:
            a = queue.pop()
            for b in ids:
                if b not in least and (prints[a] ^ prints[b]).bit_count() <= radius:
                    least[b] = d
                    queue.append(b)
    return least


def exact(rows):
    """doc_id -> (keep_id, group size, kept, digest)."""
    groups, out = defaultdict(list), {}
    for d, t in rows:
        groups[re.sub(SPACE, "", t or "")].append((-len(t or ""), d))
    for text, members in groups.items():
        keep = min(members)[1]
        for _, d in members:
            out[d] = (keep, len(members), d == keep, hashlib.sha256(text.encode()).hexdigest())
    return out


def line_dedup(rows, least=10):
    """(lines, dropped, rest) of each row, in order. A null id comes after all others."""
    blanks = " \t\n\x0b\x0c\r"
    place = lambda d: (d is None, d or 0)
    first = {}
    for d, t in sorted(rows, key=lambda r: place(r[0])):
        for line in (t or "").split("\n"):
            first.setdefault(lowered(line.strip(blanks)), d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        keys = [lowered(x.strip(blanks)) for x in lines]
        stay = [x for x, k in zip(lines, keys) if len(k) < least or first[k] == d]
        out.append((d, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def collocations(rows, longest=4, least=30, most=2000, covered=80):
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text) rows."""
    counts, n = defaultdict(int), defaultdict(int)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    counts[lang, tuple(w[i : i + k])] += 1
    frequent = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    around = defaultdict(int)
    for (lang, w), a in frequent.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                around[lang, w[i : i + k]] = max(around[lang, w[i : i + k]], a)
    found = defaultdict(list)
    for (lang, w), a in frequent.items():
        score, k = min((2000000 * a // (counts[lang, w[:k]] + counts[lang, w[k:]]), k) for k in range(1, len(w)))
        if 100 * around[lang, w] < covered * a or not around[lang, w]:
            phrase = " ".join(w)
            found[lang].append((-score, -a, phrase.encode(), phrase, counts[lang, w[:k]], counts[lang, w[k:]]))
    return [
        (lang, i, x[3], -x[1], x[4], x[5], n[lang], -x[0])
        for lang, all_ in found.items()
        for i, x in enumerate(sorted(all_)[:most], 1)
    ]


def importance(rows, target, percent=10, seed=2024, longest=1, buckets=10_000, least=20):
    """(doc_id, words, features, weight, score, rank) of each row."""

    def runs(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
        found = [" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]
        return len(w), [zlib.crc32(x.encode()) % buckets for x in found]

    seen = [(d, *runs(t)) for d, t in rows]
    s, t = Counter(b for _, _, f in seen for b in f), Counter(b for x in target for b in runs(x)[1])
    all_s, all_t = s.total() + buckets, t.total() + buckets
    out = []
    for d, n, f in seen:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in f)
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], x[0] is None, x[0] or 0, x[3], x[2]))
    for i, x in enumerate(able[: percent * len(able) // 100], 1):
        x[5] = i
    return [tuple(x) for x in out]
