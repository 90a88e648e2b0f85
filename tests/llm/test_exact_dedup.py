import hashlib
import random
import re
from collections import Counter, defaultdict

from kerbflow.llm import exact_dedup as X

PYTHON = ("Python", "Arrow", "Pandas")


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def brute(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[norm(t)].append(d)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return Counter((d, least[norm(t)], len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for d, t in rows)


def rows_with_hot_group(n=3000, seed=3):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["the  same\ttext", "the same text", "the same\r\n text"]) if i % 3 == 0 else f"text {rng.randrange(n)}") for i in range(n)]
    return rows + [(None, None), (n, ""), (n + 1, None), (n + 2, " "), (n + 3, "\x0b\x0c"), (None, "lonely"), (None, "lonely"),
                   (n + 4, "twice"), (n + 4, "twice"), (n + 5, "nb\xa0sp"), (n + 6, "nb sp"), (n + 7, "long " * 60_000), (n + 8, "long  " * 60_000)]


def check(got, rows):
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == brute(rows)
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept) == {r.text_sha256 for r in got} and set(kept.values()) == {1}
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_marks_match_brute_force_with_a_third_in_one_group(spark):
    rows = rows_with_hot_group()
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, row int, digest string").repartition(7)
    check(X.mark_copies(docs).collect(), rows)
    check(X.mark_copies(docs, share=2).collect(), rows)              # nearly nothing wins: all by the shuffle
    check(X.mark_copies(docs, share=10 ** 6).collect(), rows)        # every repeated text wins


def test_every_frequent_digest_wins_and_only_those(spark):
    rng = random.Random(5)
    texts = [f"hot {i}" for i in range(40) for _ in range(200 + i)] + [f"cold {i}" for i in range(30_000)]
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(13)
    keys = X.digest_rows(docs, "doc_id", "text")
    n, share = len(texts), 180
    want = {hashlib.sha256(t.encode()).hexdigest(): c for t, c in Counter(texts).items() if c * share > n}
    assert 0 < len(want) < 40
    assert {bytes(r.digest).hex(): r.group_size for r in X.heavy_groups(keys, share).collect()} == want


def test_winners_are_not_shuffled_and_no_python_runs(spark):
    rows = rows_with_hot_group()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = X.mark_copies(docs)
    plan = out._jdf.queryExecution().toString()
    assert not any(p in plan for p in PYTHON)
    physical = out._jdf.queryExecution().executedPlan().toString()
    assert physical.count("Exchange hashpartitioning") == 1 and physical.count("BroadcastExchange") >= 1


def test_drop_copies_keeps_other_columns(spark):
    rows = [(2, "a b", "x", 0.5), (1, "a  b", "y", 1.5), (None, "a b", "z", None), (3, None, "n", 2.0), (4, "", "e", 3.0), (5, "c", "q", 4.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, kept double")
    left = X.drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted(tuple(r) for r in left.collect()) == [rows[1], rows[3], rows[5]]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    out = X.mark_copies(docs)
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and out.count() == 0
    assert X.drop_copies(docs).count() == 0
