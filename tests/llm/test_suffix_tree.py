import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kerbflow.llm import suffix_tree as T

START, END = "START", "END"


def words(t):
    return (t or "").encode().lower().split()


def held(d):
    return zlib.crc32(b"" if d is None else str(d).encode()) % 10 == 0


def corpus(n=400, seed=4):
    """Two 'languages' whose words follow their own kind, with a pair of words that calls for a third."""
    rng = random.Random(seed)
    a, b = [f"{x}ara" for x in "bcdfgklmnp"] + ["the"], [f"{x}elo" for x in "bcdfgklmnp"] + ["die"]
    out = []
    for i in range(n):
        w = rng.choices(a if i % 2 else b, weights=[1] * 10 + [8], k=rng.randrange(3, 60))
        for k in range(2, len(w)):
            if w[k - 2] == "the" and w[k - 1] == "bara" and rng.random() < 0.9:
                w[k] = "nara"
        out.append((i, " ".join(w)))
    return out


class Brute:
    """The tree by its definition, with dictionaries of words."""

    def __init__(self, rows, depth=2, min_ending=10, min_count=30, cut=2, discount=0.75, penalty=2.0):
        self.depth = depth
        train = [words(t) for d, t in rows if not held(d)]
        self.c = Counter(w for t in train for w in [*t, END])
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.scale = self.n + 0.1 * (self.v + 1)
        share = defaultdict(float)
        for w, c in self.c.items():
            share[self.cls(w)] += (c + 0.1) / self.scale
        grams, totals = defaultdict(Counter), Counter()
        for t in train:
            for ctxs, w in self.places(t):
                for order, ctx in enumerate(ctxs, 1):
                    grams[order, ctx][self.cls(w) if order == 1 else w] += 1
                    totals[order, ctx] += 1
        self.found, self.escape, kept = {}, {}, {}
        for order in range(1, depth + 2):
            for (o, ctx), after in grams.items():
                total = totals[o, ctx]
                if o != order or total < (min_ending if order == 1 else min_count):
                    continue
                if order > 2 and (order - 1, ctx[1:]) not in self.escape:       # grown out of a gram of the order below
                    continue
                own, rows_ = [], {}
                for s, n in after.items():
                    if n < (min(cut, 2) if order == 1 else cut):
                        continue
                    root = math.log(share[s] if order == 1 else self.root(s))
                    low = root if order == 1 else self.below(order, ctx, s)
                    mine = n * (math.log(n / total) - low) > penalty
                    rows_[s] = (n, low, root, mine)
                if not rows_:
                    continue
                own = [(n, low) for n, low, _, mine in rows_.values() if mine]
                e = math.log((total - sum(n for n, _ in own) + discount * len(own)) / total) - math.log(max(1 - sum(math.exp(x) for _, x in own), 1e-9))
                self.escape[order, ctx] = e
                gain = (total - sum(n for n, _ in own)) * e
                for s, (n, low, root, mine) in rows_.items():
                    high = math.log((n - discount) / total) if mine else e + low
                    self.found[order, ctx, s] = (high, root, mine)
                    gain += n * (high - low) if mine else 0.0
                kept[order, ctx] = gain > penalty * (len(own) + 1)
        self.kept = {k for k, yes in kept.items() if yes}
        for order, ctx in sorted(self.kept, key=lambda k: -k[0]):
            while order > 1:
                order, ctx = order - 1, self.suffix(order, ctx)
                if (order, ctx) in self.escape:
                    self.kept.add((order, ctx))

    @staticmethod
    def cls(w):
        return w if w == END else w[-2:].rjust(2)

    @staticmethod
    def suffix(order, ctx):
        return ctx[1:] if order > 2 else ctx[0] if ctx[0] == START else ctx[0][-3:].rjust(3)

    def root(self, w):
        return (self.c[w] + 0.1) / self.scale

    def below(self, order, ctx, s):
        up = self.suffix(order, ctx)
        if order == 2:
            if (1, up, self.cls(s)) in self.found:
                high, root, _ = self.found[1, up, self.cls(s)]
                return math.log(self.root(s)) + high - root
            return math.log(self.root(s)) + self.escape.get((1, up), 0.0)
        return self.found[order - 1, up, s][0]

    def places(self, t):
        line = [START, *t, END]
        for i in range(1, len(line)):
            yield [self.suffix(2, (line[i - 1],)), *(tuple(line[i - k:i]) for k in range(1, self.depth + 1) if i >= k)], line[i]

    def log(self, ctxs, w):
        """log P(w) in the longest kept context."""
        for order in range(len(ctxs), 0, -1):
            if (order, ctxs[order - 1]) not in self.kept:
                continue
            s = self.cls(w) if order == 1 else w
            high, root, mine = self.found.get((order, ctxs[order - 1], s), (None, None, False))
            if mine:
                return high if order > 1 else math.log(self.root(w)) + high - root
            return self.escape[order, ctxs[order - 1]] + self.log(ctxs[:order - 1], w)
        return math.log(self.root(w))

    def score(self, t):
        return sum(self.log(ctxs, w) for ctxs, w in self.places(words(t))) / math.log(10)


def odd_rows():
    return corpus() + [(9000, None), (9001, ""), (9001, ""), (None, "The the unseen"), (9002, "\x0b\t \n"), (9003, "baRA " * 30_000),
                       (9004, "É é x\x00y"), (9005, "a b\nc"), (9006, "long" * 200 + " the bara"), (9007, "the bara")]


@pytest.mark.parametrize("small,max_counts,options", [(4_000_000, 200_000, {}), (0, 4, {}), (4_000_000, 200_000, {"min_count": 5, "penalty": 1.0, "depth": 3})])
def test_scores_match_brute_force(spark, monkeypatch, small, max_counts, options):
    monkeypatch.setattr(T, "SMALL", small)              # 0: every key is looked up by a join
    rows = odd_rows()
    docs = spark.createDataFrame([(d, t, "z") for d, t in rows], "doc_id long, text string, word string").repartition(5)
    options = {"min_ending": 10, "min_count": 30, "cut": 2, "discount": 0.75, "penalty": 2.0} | options
    got = T.score(docs, max_counts=max_counts, **options).collect()
    tree = Brute(rows, **options)
    assert len({o for o, _ in tree.kept}) >= 3 and len(tree.kept) > 20
    want = sorted((str(d), held(d), len(words(t)) + 1, sum(tree.c[w] > 0 for w in [*words(t), END]), tree.n) for d, t in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got) == want
    base = sorted((str(d), sum(math.log10(tree.root(w)) for w in [*words(t), END]), tree.score(t)) for d, t in rows)
    for (d, b, s), r in zip(base, sorted(got, key=lambda r: (str(r.doc_id), r.base_score))):
        assert d == str(r.doc_id) and abs(b - r.base_score) < 1e-6 * max(1, abs(b)) and abs(s - r.score) < 2e-5 * max(1, abs(s)), (d, b, s, r)
    out = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 9000]
    assert out and sum(r.score for r in out) > sum(r.base_score for r in out)


def test_contexts_give_distributions():
    tree = Brute(odd_rows())
    for order, ctx in sorted(tree.kept, key=str):
        if order > 1:
            ctxs = [tree.suffix(2, ctx[-1:]), *(ctx[-k:] for k in range(1, order))]
            assert abs(sum(math.exp(tree.log(ctxs, w)) for w in tree.c) - 1) < 0.01, (order, ctx)


def test_more_text_keeps_more_contexts():
    rng = random.Random(7)
    made = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 5))) for _ in range(150)]
    follow = {w: rng.sample(made, 4) for w in made}

    def text(k):
        w = [rng.choice(made)]
        for _ in range(k):
            w.append(rng.choice(follow[w[-1]]) if rng.random() < 0.7 else rng.choice(made))
        return " ".join(w)
    rows = [(i, text(60)) for i in range(1200)]
    sizes = [len(Brute(rows[:n]).kept) for n in (75, 300, 1200)]
    assert sizes[0] < sizes[1] < sizes[2]


def test_tokens_are_the_words(spark):
    rng = random.Random(3)
    texts = ["", " ", "The the  THE\nx", "été É a", "a", "\x0b\t", "abcdefgh" * 100 + " z", "b", "x\x1cy"]
    texts += ["".join(rng.choice("aAbB \t\n\ré") for _ in range(rng.randrange(300))) for _ in range(50)]
    batch = pa.RecordBatch.from_arrays([pa.array([t.encode() for t in texts], pa.binary())], names=["t"])
    known: dict = {}
    for most in (1, 100, 1 << 21):
        parts = list(T._pieces(batch, most))
        assert sum(p.num_rows for p in parts) == len(texts)
        at = 0
        for p in parts:
            x, place = T.Tokens(p.column("t")), 0
            for n in x.sizes.tolist():
                want = [*words(texts[at]), END]
                assert n == len(want)
                for w, h, tail in zip(want, x.symbols[place:place + n].tolist(), x.tails[x.places][place:place + n].tolist()):
                    assert known.setdefault(w, (h, tail)) == (h, tail)
                    assert w == END or tail == int.from_bytes(w[-3:].rjust(3), "big")
                place, at = place + n, at + 1
    assert len({h for h, _ in known.values()}) == len(known)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(4, "a b")], "doc_id long, text string")
    only_held = next(i for i in range(100) if held(i))
    r = T.score(docs.selectExpr(f"cast({only_held} as long) as doc_id", "text")).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (True, 3, 0, 0) and r.score == r.base_score
    assert T.score(docs.limit(0)).count() == 0


def test_a_words_hash_hangs_on_the_word_alone():
    import numpy as np
    import pyarrow as pa
    from kerbflow.llm import suffix_tree

    def hashes(*texts):
        return suffix_tree.Tokens(pa.array([t.encode() for t in texts], pa.binary()))

    long, gap = "ab" * 300, " " * 700
    alone = {w: int(hashes(w).symbols[0]) for w in ("one", "Two", "é", long, long + "c", "x" * 256, "x" * 257)}
    assert len(set(alone.values())) == 7 and int(hashes("two").symbols[0]) == alone["Two"]
    words = [*alone]
    for texts in ([" ".join(words)], [gap + gap.join(words) + gap], words, ["", *words, " "]):
        x = hashes(*texts)
        assert [int(h) for h in x.symbols if h != suffix_tree.END] == [*alone.values()]
        assert (x.sizes == [len(t.split()) + 1 for t in texts]).all() and np.count_nonzero(x.symbols == suffix_tree.END) == len(texts)


def test_mapped_tables_find_what_tables_in_memory_find(spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK", 300)                # several files
    rng = np.random.default_rng(4)
    keys = rng.integers(0, 2 ** 63 - 1, 2000)
    keys[:6] = [0, 1, 2 ** 62, 2 ** 62 + 1, 2 ** 63 - 2, 5]
    values = rng.normal(size=2000)
    df = spark.createDataFrame(list(zip(keys.tolist(), values.tolist())), "key long, value double")
    asked = np.concatenate([rng.permutation(keys)[:1500], rng.integers(0, 2 ** 63 - 1, 500), keys[:6] + 2])
    for n in (2000, 1, 0):
        blocks = T.sorted_files(df.limit(n) if n < 2000 else df, "test-sorted")
        table = T.MappedTable(blocks)
        assert len(table.keys) == n and (n < 2000 or len(blocks) > 3)
        here, found = table.find(asked)
        want_here, want = T.KeyTable(table.keys.copy(), table.values.copy()).find(asked)
        assert (here == want_here).all() and (found == want).all()
        if n == 2000:
            known = dict(zip(keys.tolist(), values.astype(np.float32)))
            assert here.tolist() == [k in known for k in asked.tolist()] and found.tolist() == [known[k] for k in asked[here].tolist()]


def test_no_token_key_is_written_when_tables_are_large(spark, monkeypatch):
    monkeypatch.setattr(T, "SMALL", 0)
    kept, plain = {}, T.written
    monkeypatch.setattr(T, "written", lambda s, df, name: kept.update({name: plain(s, df, name)}) or kept[name])
    docs = spark.createDataFrame([(d, t) for d, t in odd_rows() if len(t or "") < 10_000], "doc_id long, text string")
    out = T.score(docs, min_count=30, cut=2, penalty=2.0).agg(F.sum("score"), F.sum("base_score")).first()
    assert out[0] > out[1] + 1
    lists = [f.name for f in kept["lm-scores"].schema.fields if f.dataType.typeName() == "array"]
    assert lists == ["rest"]                            # words of the tail alone
