import random

import numpy as np
import pytest

from kerbflow.llm import toxicity as X


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_over_trie_matches_edit_distance():
    rng = random.Random(3)
    terms = ["idiot", "scum", "worthless", "abc", "disgusting", "aab"]
    stems = ["lowei", "vequ"]
    trie = X.LexiconTrie(terms, stems)
    words = list(terms) + stems + ["loweiheit", "lowaiheit", "id1ot", "idi0t", "idiiot", "worthles", "wrothless", "", "a"]
    for _ in range(3000):
        w = list(rng.choice(terms + stems))
        for _ in range(rng.randrange(4)):
            k = rng.randrange(3)
            p = rng.randrange(len(w) + 1)
            if k == 0:
                w.insert(p, rng.choice("abcdeiost"))
            elif w and k == 1:
                w.pop(min(p, len(w) - 1))
            elif w:
                w[min(p, len(w) - 1)] = rng.choice("abcdeiost")
        words.append("".join(w))
    for w in words:
        best = [distance(w, t) for t in terms if distance(w, t) <= X.edits_of(t)]
        best += [0 for s in stems if w.startswith(s)]
        assert trie.match(w) == (min(best) if best else None), w


def test_context_separates_quotation_from_abuse():
    m = X.Matcher(["idiot"], [], frozenset({"idiom"}))
    weight = lambda t: X.features(t, m)[1][0][2]      # noqa: E731
    assert weight("you are an idiot") > weight("an idiot sat there") > weight('he said the word idiot') > weight('the word "idiot" is old')
    assert X.features("an idiom", m)[1] == []
    assert X.features("an Idi0t!", m)[0][1] > 0 == X.features("an Idi0t!", m)[0][0]
    assert X.features(None, m) == ((0.0,) * 5, []) == X.features("", m)


def corpus(n=900, seed=5):
    rng = random.Random(seed)
    fill = ["%s%s" % (a, b) for a in ("ba", "do", "ki", "lu", "me") for b in ("ran", "tel", "vos", "wim", "zun", "pag")]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(fill, k=rng.randrange(5, 60))
        toxic = i % 9 == 0
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["blorgh", "snarfle", "grubbex" + rng.choice("abcdefgh"), "blorhg" if i % 5 == 0 else "blorgh"]))
        docs.append((i, " ".join(words), "clash"))
        if i % 3 < 2 or toxic:
            labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_edge_rows(spark):
    docs, labels = corpus()
    long = "baran " * 20_000
    extra = [(5000, None, "x"), (5001, "", "x"), (None, "baran", "x"), (5002, long, "x"), (5002, long, "x"), (5003, long + "blorgh snarfle " * 9, "x")]
    d = spark.createDataFrame(docs + extra, "doc_id long, text string, score string")
    lab = spark.createDataFrame([*labels, (1, 0, None), (None, 1, 1), (7, 1, 0), (7, 1, 0)], "doc_id long, quality int, toxic int")
    got = X.score(d, lab).collect()
    assert len(got) == len(docs) + len(extra)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    by = {r.doc_id: r for r in got}
    assert all(by[i].predicted == int(i % 9 == 0) for i, _, _ in docs)
    assert by[5000].predicted == by[5001].predicted == by[5002].predicted == 0
    assert by[5000].score == by[5001].score


def test_without_labels_or_rows(spark):
    d = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.predicted for r in X.score(d, none).collect()] == [0, 0]
    assert X.score(d.limit(0), none).count() == 0


@pytest.mark.parametrize("y", [[], [1, 1], [0, 0, 0]])
def test_logistic_with_one_class(y):
    w = X.fit_logistic(np.zeros((len(y), 2)), np.array(y, float))
    assert np.isfinite(w).all()


def test_misspelt_beginnings_match_stems():
    rng = random.Random(7)
    terms, stems = ["idiot", "scum", "vequantorio"], ["lowei", "vequ", "snarflebu", "ido"]
    trie, words = X.LexiconTrie(terms, stems, stem_edits=True), ["lowaiheit", "1oweiheit", "lwei", "vqeu", "", "xdo", "idox"]
    for _ in range(4000):
        w = list(rng.choice(terms + stems) + "".join(rng.choices("abeiou", k=rng.choice([0, 0, 1, 4, 9]))))
        for _ in range(rng.randrange(4)):
            p = rng.randrange(len(w))
            w[p:p + rng.randrange(2)] = rng.choice(["", "a", "e", "q"])
            w = w or ["x"]
        words.append("".join(w))
    for w in words:
        best = [distance(w, t) for t in terms if distance(w, t) <= X.edits_of(t)]
        best += [e for s in stems for e in [min(distance(w[:k], s) for k in range(len(w) + 1))] if e <= X.edits_of(s)]
        assert trie.match(w) == (min(best) if best else None), w
    m = X.Matcher([], ["lowei"], frozenset({"lowenbrau"}))
    assert m.found(["lowaiheit", "loweiheit", "lowenbrau"]) == {"lowaiheit", "loweiheit"}
    assert m.hits == {"lowaiheit": 2, "loweiheit": 1}


def test_learned_stem_finds_misspelt_beginnings(spark):
    docs, labels = corpus()
    terms, stems, benign = X.learn_lexicon(
        spark.createDataFrame([(t, int(i % 9 == 0)) for i, t, _ in docs], "text string, toxic int"), 100, 800)
    assert any("grubbex".startswith(s) or s.startswith("grubbex") for s in stems)
    m = X.Matcher(terms, stems, frozenset(benign))
    assert m.found(["grxbbexa", "grubexc", "vos"]) == {"grxbbexa", "grubexc"}
