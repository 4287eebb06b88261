"""URL filters: which rule of a host and path list applies to each url.

Method: sort-merge range join. A host is keyed by its labels in reverse, each followed by a
separator that sorts before every other byte, so the keys of a host and all its subdomains are one
interval that starts at the rule's own key, and intervals nest or are disjoint. Urls are range
partitioned and sorted by key; each task sweeps urls and rules together and keeps a stack of the
rules whose intervals are open. Of these the longest whose path starts the url's path wins.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalspark.llm.rows import put_back, set_aside

#: Rules swept in one pass over the urls; longer lists take more passes.
PASS_RULES = 200_000


def key_of(host: str) -> bytes:
    r"""Reversed labels, each closed by \x00; \x00 inside a host becomes \x00\x01 to keep order."""
    return b"".join(x.encode("utf-8", "surrogatepass").replace(b"\x00", b"\x00\x01") + b"\x00\x00" for x in reversed(host.split(".")))


class Rules:
    """Rules sorted by key. `outer` is the nearest rule whose interval holds a rule's own."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        grouped: dict[bytes, list] = {}
        for host, path, verdict in rules:
            grouped.setdefault(key_of(host), []).append((host, path, verdict))
        self.keys = sorted(grouped)
        # Longest rule first; a block beats an allow of the same rule.
        self.rules = [sorted(grouped[k], key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r[2] != "block")) for k in self.keys]
        self.outer: list[int] = []
        stack: list[int] = []
        for i, k in enumerate(self.keys):
            while stack and not k.startswith(self.keys[stack[-1]]):
                stack.pop()
            self.outer.append(stack[-1] if stack else -1)
            stack.append(i)


def _sweep(rules: Rules):
    def batches(parts):
        at, stack = None, []
        for batch in parts:
            names, verdicts = batch["rule"].to_pylist(), batch["verdict"].to_pylist()
            sizes = batch["rule_size"].to_pylist()
            last = None
            for row, (host, path) in enumerate(zip(batch["host"].to_pylist(), batch["path"].to_pylist())):
                if not host:
                    continue
                if host != last:
                    last, key = host, key_of(host)
                    if at is None:  # where this task's range begins: open what already holds it
                        at = bisect_right(rules.keys, key)
                        stack, i = [], at - 1
                        while i >= 0:
                            stack.insert(0, i)
                            i = rules.outer[i]
                    while at < len(rules.keys) and rules.keys[at] <= key:
                        while stack and not rules.keys[at].startswith(rules.keys[stack[-1]]):
                            stack.pop()
                        stack.append(at)
                        at += 1
                    while stack and not key.startswith(rules.keys[stack[-1]]):
                        stack.pop()
                best = None
                for i in stack:
                    for rule in rules.rules[i]:
                        if path.startswith(rule[1]):
                            size = (len(rule[0]) + len(rule[1]), len(rule[0]))
                            if best is None or size > best[0]:
                                best = size, rule
                            break
                if best is not None and best[0][0] > sizes[row]:
                    names[row], verdicts[row] = best[1][0] + best[1][1], best[1][2]
                    sizes[row] = best[0][0]
            for name, column in (("rule", names), ("verdict", verdicts), ("rule_size", sizes)):
                i = batch.schema.get_field_index(name)
                batch = batch.set_column(i, batch.schema.field(i), pa.array(column, batch.schema.field(i).type))
            yield batch

    return batches


def host_and_path(url: str):
    """Host (A-Z lower-cased) and path columns: what stands behind the first `://` up to `/`, `?`,
    `#` or the end, and then up to `?`, `#` or the end. Both empty without `://`."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    host = F.regexp_extract(text, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def filter_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    url: str = "url",
    default: str = "allow",
    pass_rules: int = PASS_RULES,
) -> DataFrame:
    """The pages with host, path, rule (host and path of the one that decided, like `net/`; else
    null) and verdict (the rule's; `default` if none fits).

    `rules` are (host without trailing slash, path, verdict), a list the caller holds; it is swept
    in passes of `pass_rules`. A rule fits its host and all subdomains if the url's path starts
    with the rule's; the longest wins, by host and path together, then by host, then block before
    allow. Null urls and urls without `://` have empty host and path and fit no rule. Repeated
    pages are judged alike. Columns of `pages` named like a result are replaced, all others kept,
    whatever their names.
    """
    results = ("host", "path", "rule", "verdict")
    kept = pages.drop(*results).columns
    host, path = host_and_path(url)
    found = pages.select(
        *set_aside(kept),
        host.alias("host"),
        path.alias("path"),
        F.lit(None).cast("string").alias("rule"),
        F.lit(default).alias("verdict"),
        F.lit(-1).alias("rule_size"),
        F.xxhash64(url).alias("spread"),
    )
    # Sorted by key: labels in reverse, compared label by label. Path and url split a hot host.
    labels = F.reverse(F.split(F.regexp_replace("host", "\x00", "\x00\x01"), r"\."))
    key = F.concat(F.concat_ws("\x00\x00", labels), F.lit("\x00\x00"))
    found = found.withColumn("key", key).repartitionByRange("key", "path", "spread").sortWithinPartitions("key")
    found = found.drop("key", "spread")
    rules = sorted(rules, key=lambda r: (-len(r[0]), r[2] != "block"))
    for first in range(0, len(rules), pass_rules):
        found = found.mapInArrow(_sweep(Rules(rules[first : first + pass_rules])), found.schema)
    return found.select(*put_back(kept), *results)
