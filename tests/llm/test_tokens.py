import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kerbflow.llm import packing, token_files
from kerbflow.llm.common import WordIds

ODD = ["", " ", "\n", "a", "Hello, world.", "  two  spaces ", "tab\tand\x0bvt", "it's we'll don't 'quoted'", "x\n\ny\n z", " \n ",
       "é É ñandú ß İstanbul ΣΑΣ", "nb\xa0sp em", "12,345.67 a1b2", "wait...what?!", "end. ", "\n.", "a .b", "***bold*** foo*** $$$",
       "<|endoftext|> a<|endoftext|>b", "end <|endoftext|> of it", "<|startoftext|>x <|STARTOFTEXT|>", "<|endoftext|><|endoftext|>\n", "<|endoftext", "emoji 😀 text", "é ́x", "µm ª º ² ½", "foo_bar _x_ __", "\x1cfs\x1d", "L’été «là»", "word " * 3000]


@pytest.mark.parametrize("name,keeps", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_word_cache_equals_whole_texts(name, keeps):
    path = public_tokenizers.path(name)
    tok = Tokenizer.from_file(path)
    rng = random.Random(7)
    texts = ODD + ["".join(rng.choice("ab é.,'\n *\t1X-ß") for _ in range(rng.randrange(60))) for _ in range(400)]
    for limit in (80_000_000, 4000):
        ids = WordIds(path, keeps, limit)
        for i in range(0, len(texts), 50):
            got = ids.encode(texts[i:i + 50])
            for t, g in zip(texts[i:i + 50], got):
                assert np.frombuffer(g, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("name,keeps", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_word_cache_holds_words_and_no_runs_of_space(name, keeps):
    path = public_tokenizers.path(name)
    tok = Tokenizer.from_file(path)
    ids = WordIds(path, keeps)
    texts = ["one two\nthree two", "one  two\n\n three,  two ", "\nthree", "\n", " one", "two \n", "one\n\n\ntwo", "", " "]
    for t, g in zip(texts, ids.encode(texts), strict=True):
        assert np.frombuffer(g, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)
    assert {"one", "two"} <= ids.cache.keys() and (not keeps or not {"", "\n"} & ids.cache.keys())
    size = ids.size
    assert size and ids.encode(texts[:1]) == ids.encode(texts[:1]) and ids.size == size


def test_word_is_learned_once_whatever_marks_and_case():
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    ids = WordIds(path, False)
    rng = random.Random(11)
    latin = "".join(map(chr, range(256)))
    texts = ["One, two. TWO three, one.", "É, é.\nÉ two, éa.", 'Three, "two", é.']
    assert [np.frombuffer(g, "<u4").tolist() for g in ids.encode(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert set(ids.cache) == {"one", ",", "two", ".", "three", "é", "éa", '"', '",'}
    parts = ["'S", "'ll", "'", "s", "É", "²", "5", "-", " ", "\n", "ª", "×", "\x7f", "_", "’", "ﬁ"]
    texts = [*latin, *("".join(rng.choices(latin + "  \n'sSÉé.,", k=rng.randrange(1, 40))) for _ in range(3000)),
             *("".join(rng.choices(parts, k=12)) for _ in range(2000)), *("".join(rng.choices(parts[:-2], k=12)) for _ in range(2000))]
    for t, g in zip(texts, ids.encode(texts), strict=True):
        assert np.frombuffer(g, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_worker_holds_one_operators_state_and_slices_are_small():
    import pyarrow as pa
    from kerbflow.llm import common
    assert common.worker_held("a", lambda: [1]) == [1] == common.worker_held("a", lambda: [2])
    common.worker_freed()
    assert common.worker_held("a", lambda: [2]) == [2]
    common.worker_freed()
    parts = list(common.slices([pa.RecordBatch.from_pydict({"t": list(range(n))}) for n in (0, 7, 3)], 3))
    assert [b.num_rows for b in parts] == [3, 3, 1, 3] and sum((b.column(0).to_pylist() for b in parts), []) == [*range(7), *range(3)]


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 32])
def test_bit_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1003, dtype=np.uint64).astype("<u4")
    raw = token_files.pack_bits(ids, bits)
    assert len(raw) == -(-1003 * bits // 8)
    assert (token_files.unpack_bits(raw, bits, 1003) == ids).all()


def test_token_files_round_trip_and_random_access(spark):
    rows = [(9 - i % 10, t, "c") for i, t in enumerate(ODD[:28])] + [(None, "null id", "c"), (77, None, "c"), (5, "same", "c"), (5, "same", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(3)
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    manifest = token_files.write_tokens(spark, docs, path, 2, ids_per_file=100, block=64)
    got = sorted(token_files.read_tokens(manifest).collect(), key=lambda r: r.start)
    want = [(d, tok.encode(t or "", add_special_tokens=False).ids + [2]) for d, t, _ in
            sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))]
    start, flat = 0, []
    for r, (d, ids) in zip(got, want, strict=True):
        assert tuple(r) == (d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
        flat += ids
    seen = []
    for m in sorted(manifest.collect(), key=lambda m: (m.part, m.piece)):
        f = token_files.TokenFile(m.path)
        whole = f.ids(0, f.n_ids).tolist()
        for s, n in ((0, 1), (len(whole) // 2, 7), (max(0, len(whole) - 3), 3), (0, 0)):
            assert f.ids(s, min(n, len(whole) - s)).tolist() == whole[s:s + n]
        seen += whole
        f.close()
    assert seen == flat and token_files.least_bits(49408) == 16
    assert token_files.token_files_query(spark, docs.limit(0)).count() == 0


def test_plan_is_whole_and_tight():
    rng = random.Random(2)
    for capacity in (10, 64, 2048):
        counts = {rng.randrange(1, capacity + 1): rng.randrange(1, 500) for _ in range(60)}
        groups = packing.plan(counts, capacity)
        used, n = {}, 0
        for m, pattern in groups:
            n += m
            place = 0
            for length, k, offset in pattern:
                assert offset == place
                place += length * k
                used[length] = used.get(length, 0) + m * k
            assert place <= capacity
        assert used == counts
        bound = -(-sum(k * v for k, v in counts.items()) // capacity)
        best_fit, bins = 0, []
        for length in sorted(counts, reverse=True):
            for _ in range(counts[length]):
                fit = min((r for r in bins if r >= length), default=None)
                if fit is None:
                    best_fit += 1
                    fit = capacity
                else:
                    bins.remove(fit)
                bins.append(fit - length)
        assert bound <= n <= best_fit
    assert packing.plan({}, 8) == []


def test_packing_places_every_piece_once(spark):
    rows = [(i, t, "c") for i, t in enumerate(ODD)] + [(None, "a b", "c"), (3, None, "c"), (4, "dup", "c"), (4, "dup", "c"), (99, "lang " * 9000, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string")
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    got = packing.pack(docs, path, capacity=512).collect()
    want, total = [], 0
    for d, t, _ in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        total += len(ids)
        first = (len(ids) - 1) % 512 + 1
        for k, s in enumerate([0, *range(first, len(ids), 512)]):
            x = ids[s:first if k == 0 else s + 512]
            want.append((d, k, s, len(x), zlib.crc32(x.tobytes())))
    key = lambda r: tuple(map(str, r))                 # noqa: E731
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        place = 0
        for o, n in sorted(b):
            assert o == place
            place += n
        assert place <= 512
    assert len(bins) <= -(-total // 512) + 1
    pieces = packing.pieces_of(docs, path, 0, 512, with_ids=True).cache()
    whole = packing.sequences(packing.place(pieces, 512)).collect()
    assert sum(len(bytes(r.ids)) // 4 for r in whole) == total
    assert packing.packing_query(docs.limit(0)).count() == 0
