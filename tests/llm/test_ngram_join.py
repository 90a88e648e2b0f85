import collections
import random

import pytest

from kerbflow.llm import ngram_join as J


def brute(rows, n=5, over=4, under=5):
    """links and components by comparing all pairs of rows with words and an id."""
    grams = []
    for d, t in rows:
        w = (t or "").lower().split()
        grams.append({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w and d is not None else set())
    links, root = collections.Counter(), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(grams):
        for j in range(i):
            b = grams[j]
            if a and b and under * len(a & b) >= over * len(a | b):
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return collections.Counter((d, least.get(find(i)), links[i]) for i, (d, _) in enumerate(rows))


def near_copies(seed=1):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(400)]
    rows = []
    for base in range(12):
        text = rng.choices(words, k=rng.choice([3, 6, 40, 120]))
        for _ in range(rng.choice([1, 2, 5])):
            copy = list(text)
            for _ in range(rng.choice([0, 0, 1, 2, 6])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows) * 7 + 3, " ".join(copy)))
    return rows


EDGE = [(1, None), (2, ""), (3, " \n\t"), (4, "Hi"), (5, "hi"), (None, "hi"), (6, "a b c d e f"), (6, "a b c d e f"),
        (7, "A  b c\nd e F"), (8, "a b c d e"), (9, "x " * 9000), (10, "x " * 50), (11, "other words here now then")]


@pytest.mark.parametrize("block", [512, 3])
def test_links_and_classes_match_all_pairs(spark, block):
    rows = near_copies() + [(None if d is None else d + 10_000, t) for d, t in EDGE]
    docs = spark.createDataFrame([(d, t, b"x", "y") for d, t in rows], "doc_id long, text string, node binary, bands string")
    got = J.ngram_join(docs, block=block).collect()
    assert collections.Counter((r.doc_id, r.class_id, r.n_links) for r in got) == brute(rows)


def test_one_large_group_of_near_copies_in_blocks(spark):
    rows = [(i, " ".join(f"w{k}" if k != i % 40 else f"v{i}" for k in range(120))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = J.ngram_join(docs, block=16).collect()
    assert collections.Counter((r.doc_id, r.class_id, r.n_links) for r in got) == brute(rows)
    assert {r.doc_id for r in J.one_of_each(docs).collect()} == {0}


def test_empty_table_and_bands(spark):
    assert J.ngram_join(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    b = J.bands_for(0.8, 0.9999)
    assert 1 - (1 - 0.8 ** 5) ** b >= 0.9999 > 1 - (1 - 0.8 ** 5) ** (b - 1)


def test_one_row_of_each_class_whatever_the_ids(spark):
    text = lambda k: " ".join(f"{k}w{i}" for i in range(60))       # noqa: E731
    rows = [(5, text("a"), 1), (5, text("a"), 2), (5, text("a"), 3),                        # a source loaded again
            (7, text("b"), 4), (9, text("b"), 5), (9, text("c"), 6),                        # 9 is a copy's id and another text's
            (None, text("d"), 7), (None, text("d"), 8), (None, text("d") + " x", 9),        # copies without ids
            (None, text("e"), 10), (-3, text("e"), 11), (4, text("e"), 12), (30, text("e") + " x", 13),
            (None, None, 14), (None, "", 15), (8, None, 16), (8, None, 17), (None, text("f"), 18)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_key int")
    got = J.one_of_each(docs)
    assert got.columns == docs.columns
    got = {r.row_key: (r.doc_id, r.text) for r in got.collect()}
    assert all(got[k] == (d, t) for d, t, k in rows if k in got)
    assert len({1, 2, 3} & got.keys()) == len({7, 8, 9} & got.keys()) == 1
    assert got.keys() - {1, 2, 3, 7, 8, 9} == {4, 6, 11, 14, 15, 16, 17, 18}
