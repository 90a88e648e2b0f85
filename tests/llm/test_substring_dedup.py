import collections
import hashlib
import random

import pytest

from kerbflow.llm import substring_dedup as S


def brute(rows, window):
    texts = [(t or "").encode().split() for _, t in rows]
    n = collections.Counter(tuple(w[i:i + window]) for w in texts for i in range(len(w) - window + 1))
    out = collections.Counter()
    for (d, _), w in zip(rows, texts):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if n[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


def corpus(seed=6):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(300)] + ["é", "X", "x"]
    passages = [rng.choices(words, k=k) for k in (34, 35, 36, 60, 140)]
    rows = []
    for i in range(80):
        w = rng.choices(words, k=rng.randrange(0, 120))
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            s = rng.randrange(len(p) // 2)
            k = rng.randrange(len(w) + 1)
            w[k:k] = p[s:] if rng.random() < .5 else p
        rows.append((i, rng.choice([" ", "\n", "  "]).join(w)))
    own = rng.choices(words, k=50)
    rows += [(200, " ".join(own + ["mid"] + own)), (201, "ab " * 200), (202, "ab " * 36), (203, None), (204, ""), (204, ""),
             (None, rows[5][1]), (205, rows[7][1]), (205, rows[7][1]), (205, "other text"), (206, " ".join(rng.choices(words, k=15_000)))]
    return rows


@pytest.mark.parametrize("limits", [{}, {"shard_bytes": 300}, {"hot_segments": 1}])
def test_matches_brute_force(spark, limits):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, 1, "c") for d, t in rows], "doc_id long, text string, key int, anchor string")
    got = S.repeats(docs, **limits).collect()
    assert collections.Counter(map(tuple, got)) == brute(rows, 35)


def test_hot_passage_and_kept_text(spark):
    p = " ".join(f"p{k}" for k in range(40))
    rows = [(i, f"a{i} b{i} {p} c{i}") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = S.repeats(docs, with_text=True, hot_segments=10).collect()
    assert all(r.n_removed == 40 and r.kept_text == f"a{r.doc_id} b{r.doc_id} c{r.doc_id}" for r in got) and len(got) == 120
    assert S.repeats(docs.limit(0)).count() == 0


def test_automaton_finds_overlapping_phrases():
    automaton, numbers = S.automaton_of([b"a b c", b"b c d", b"x y"])
    assert S.occurrences(automaton, numbers, b"q a b c d q x y x".split()) == [(1, 5), (6, 8)]
    assert S.occurrences(automaton, numbers, b"a b q".split()) == []
