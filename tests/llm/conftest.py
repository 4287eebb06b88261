import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def rows(documents):
    return [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]


def texts(seed: int, n: int = 60, passages: int = 6):
    """Small documents with shared passages, copies, loops, nulls, empty, blank and long ones."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["ä", "ñandú", "日本", "X", "The"]

    def prose(k):
        return rng.choice([" ", "  ", "\n"]).join(rng.choice(words) for _ in range(k))

    shared = [prose(rng.randint(15, 60)) for _ in range(passages)]
    out = [None, "", " \n\t", "one", "loop " * 70, prose(3000)]
    while len(out) < n:
        body = [prose(rng.randint(1, 60))]
        for _ in range(rng.randint(0, 2)):
            body.insert(rng.randint(0, len(body)), rng.choice(shared))
        if rng.random() < 0.15:
            body = [rng.choice([t for t in out if t] or ["x"])]
        out.append(" ".join(body))
    order = list(range(n))
    rng.shuffle(order)
    return [(i * 3, out[k]) for i, k in enumerate(order)]


@pytest.fixture(params=[1, 2])
def small(request):
    return texts(request.param)


@pytest.fixture
def frame(spark):
    def make(rows, ddl="doc_id bigint, text string", parts=3):
        return spark.createDataFrame(rows, ddl).repartition(parts)

    return make
