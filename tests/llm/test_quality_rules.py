import collections
import re

from kerbflow.llm import quality_rules as Q

WORD = r"[^\x20\x09-\x0D]"


def brute(t):
    t = t or ""
    w = re.findall(WORD + "+", t)
    lines = [x for x in t.split("\n") if re.search(WORD, x)]
    wins = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = collections.Counter(wins)
    hit = {i + k for i, x in enumerate(wins) if n[x] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit))


TEXTS = [None, "", " \n\t ", "a", "a a a", "a a a a", "one two three one two three", "é# $x\nb\nb\n \nb ",
         "the cat\nthe cat\nand the dog " * 40, "x\x0by\x0cz w", "- a\n- b", "word " * 3000, "wait...\nno…\nyes"]


def test_counts_match_brute_force(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, "a b c", "x"), (4, "a a a", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    got = Q.quality_rules_query(docs).collect()
    assert len(got) == len(rows)
    want = collections.Counter((i, *brute(t)) for i, t, _ in rows)
    assert collections.Counter(tuple(r)[:6] for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_verdicts_and_empty_table(spark):
    clean = " ".join(f"the x{a}{b} of" for a in "abcdefgh" for b in "qrstuvw")
    docs = spark.createDataFrame([(1, clean), (2, clean.replace("of", "of***")), (3, clean.replace("the ", ""))],
                                 "doc_id long, text string")
    assert {r.doc_id: r.kept for r in Q.quality_rules_query(docs).collect()} == {1: True, 2: False, 3: False}
    assert Q.judge(docs).where("doc_id = 2").first().failed_rules == ["symbol_ratio", "stop_kinds"]
    assert Q.quality_rules_query(docs.limit(0)).count() == 0
