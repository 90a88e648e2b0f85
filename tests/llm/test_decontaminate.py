import collections
import hashlib
import random
import re

from kerbflow.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(t, bench, window=13):
    w, hit, items = words(t), set(), set()
    for i, x in bench:
        b = words(x)
        m = min(window, len(b))
        wins = {tuple(b[k:k + m]) for k in range(len(b) - m + 1)} if b else set()
        for k in range(len(w) - m + 1) if b else ():
            if tuple(w[k:k + m]) in wins:
                hit |= set(range(k, k + m))
                items.add("null" if i is None else str(i))
    names = ",".join(sorted(items))
    return len(w), len(hit), len(items), hashlib.sha256(names.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


def cases():
    rng = random.Random(11)
    vocab = ["aa", "b", "Ca", "d1", "é", "ff"]
    bench = [(i, " ".join(rng.choices(vocab, k=rng.choice([1, 2, 5, 12, 13, 14, 30])))) for i in range(2, 14)]
    bench = [b for b in bench if len(b[1].split()) > 2]
    bench += [(100, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"), (101, None), (102, " .,! "),
              (10, "unique short item"), (10, "unique short item"), (1, "ONE two three four five six seven eight nine ten eleven twelve thirteen")]
    docs = [(i, " ".join(rng.choices(vocab, k=rng.randrange(0, 80)))) for i in range(60)]
    for i in range(60, 120):
        w = rng.choices(vocab + ["zz", "yy"], k=30)
        x = (rng.choice(bench)[1] or "").split()
        k = rng.randrange(30)
        docs.append((i, ", ".join(w[:k] + x + w[k:])))
    docs += [(200, None), (201, ""), (None, "Unique SHORT-item"), (202, "unique short. item\nx"), (203, "unique short"),
             (204, "pad " * 30_000 + "unique short item"), (202, "unique short. item\nx"),
             (205, "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen")]
    return docs, bench


def test_matches_brute_force_with_one_and_many_automata(spark):
    docs, bench = cases()
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, n_words int")
    b = spark.createDataFrame([(i, t, "x") for i, t in bench], "item_id long, text string, doc_id string")
    want = collections.Counter((i, *brute(t, bench)) for i, t in docs)
    for shard_words in (2_000_000, 20):
        got = D.decontaminate(d, b, shard_words=shard_words).drop("items", "spans").collect()
        assert collections.Counter(map(tuple, got)) == want
    flags = collections.Counter((r.doc_id, r.contaminated) for r in D.flag(d, b).collect())
    assert flags == collections.Counter((i, brute(t, bench)[-1]) for i, t in docs)


def test_spans_are_removed(spark):
    docs = spark.createDataFrame([(1, "Keep this - unique short item, and this too"), (2, "clean"), (3, "unique short item"), (4, None)],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(1, "unique short item")], "item_id long, text string")
    got = {r.doc_id: r.text for r in D.remove_spans(docs, bench).collect()}
    assert got == {1: "Keep this and this too", 2: "clean", 4: None}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    r = D.decontaminate_query(docs, none).first()
    assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (2, 0, 0, False)
    assert D.decontaminate_query(docs.limit(0), none).count() == 0
