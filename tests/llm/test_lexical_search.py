import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from kerbflow.llm import lexical_search as L

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(t):
    return TERM.findall((t or "").translate(LOWER))


def brute(docs, items, k=20):
    """(item row, item_id) -> [(score, doc_id)] by the definition, all documents against every item."""
    split = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs]
    split = [x for x in split if x[2]]
    big_n, big_l = len(split), sum(n for *_, n in split)
    df = Counter(t for _, c, _ in split for t in c)
    w = {t: math.floor(1000 * math.log((2 * big_n + 2) / (2 * f + 1))) for t, f in df.items()}
    out = []
    for item_id, text in items:
        q = Counter(terms(text))
        found = []
        for d, c, n in split:
            m = 75 + (25 * n * big_n) // big_l
            s = sum(x * w[t] * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * m)) for t, x in q.items() if c[t])
            if s > 0:
                found.append((s, d))
        found.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out += [(item_id, r, d, s) for r, (s, d) in enumerate(found[:k], 1)]
    return Counter(out)


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(300)] + ["the", "The", "été", "ÉTÉ", "x1"]
    text = lambda k: " ".join(rng.choice(words) + rng.choice(["", ".", ",", "_", "\n"]) for _ in range(k))     # noqa: E731
    docs = [(i, text(rng.randrange(1, 60))) for i in range(n)]
    docs += [(n + i, docs[5][1]) for i in range(30)]                      # ties beyond the 20th place
    docs += [(None, docs[5][1]), (None, None), (n + 100, None), (n + 101, ""), (n + 102, "... \x00 -"), (n + 103, "w1 " * 50_000), (7, docs[5][1])]
    items = [(i, text(rng.randrange(1, 40))) for i in range(25)]
    items += [(100, docs[5][1]), (101, None), (102, ""), (103, "nowhere else"), (104, "w1 w1 w1 the"), (100, "the the x1"), (None, "w2 w3"), (105, "!!")]
    return docs, items


@pytest.mark.parametrize("segment,block", [(4_000_000, 200_000), (700, 40), (1, 100_000)])
def test_ranks_match_brute_force(spark, segment, block):
    docs, items = corpus(300 if segment > 1 else 40, segment)
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, score int").repartition(5)
    i = spark.createDataFrame([(i, t, "r") for i, t in items], "item_id long, text string, rank string")
    got = L.search(d, i, segment=segment, block=block).collect()
    assert Counter(tuple(r) for r in got) == brute(docs, items)


def random_lists(rng, n_docs, m, steep):
    lists, scores = [], np.zeros(n_docs, dtype=np.int64)
    for _ in range(m):
        size = rng.randrange(1, n_docs + 1)
        docs = np.array(sorted(rng.sample(range(n_docs), size)), dtype=np.int32)
        impacts = np.array([int(1 + 1000 * rng.random() ** steep) // rng.choice([1, 100]) for _ in docs], dtype=np.int64)
        weight = rng.randrange(1, 5)
        lists.append((weight, L.ImpactList(docs, impacts)))
        scores[docs] += weight * impacts
    return lists, scores


def test_best_positions_never_miss_a_tie():
    rng = random.Random(2)
    for trial in range(300):
        n, k = rng.randrange(1, 400), rng.choice([1, 3, 20])
        lists, scores = random_lists(rng, n, rng.randrange(1, 6), rng.choice([1, 6]))
        (docs, got), _ = L.best_positions(lists, n, [], k, run=rng.choice([1, 2, 16]))
        assert (scores[docs] == got).all() and len(set(docs.tolist())) == len(docs)
        order = sorted((-s, d) for d, s in enumerate(scores.tolist()) if s > 0)[:k]
        mine = sorted((-s, d) for d, s in zip(docs.tolist(), got.tolist()))[:k]
        assert mine == order, trial


def test_reading_stops_early_and_sooner_with_a_floor():
    rng = random.Random(9)
    lists, scores = random_lists(rng, 20_000, 4, 12)
    whole = sum(len(x.docs) for _, x in lists)
    _, read = L.best_positions(lists, 20_000, [], 20)
    assert read < whole / 3
    (docs, _), again = L.best_positions(lists, 20_000, [int(scores.max()) + 1] * 20, 20)
    assert again < read and len(docs) == 0


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.limit(0), items.limit(0))):
        out = L.search(d, i)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0
