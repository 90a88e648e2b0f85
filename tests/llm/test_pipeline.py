import collections
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import corpus_pipeline as P
from tests.llm.test_toxicity import corpus


@pytest.fixture(scope="module")
def sf_dir(tmp_path_factory):
    """A small corpus with toxic documents, copies, near copies, benchmark passages and personal data."""
    rng = random.Random(8)
    folder = tmp_path_factory.mktemp("sf")
    docs, labels = corpus(500)
    docs = [(i, t) for i, t, _ in docs]
    fresh = lambda n: " ".join(f"f{rng.randrange(10**6)}" for _ in range(n))       # noqa: E731
    base = fresh(60)
    docs += [(1000, base), (1001, base), (1002, base + " tail"), (1003, base.replace(base.split()[30], "changed"))]
    item = fresh(20)
    docs += [(1100, f"{fresh(10)} {item} {fresh(10)}"), (1101, fresh(30)), (1102, None), (1103, ""), (1104, f"{fresh(8)} a.bc@mail.example.com {fresh(8)}")]
    write = lambda name, **cols: pq.write_table(pa.table(cols), folder / f"{name}.parquet")      # noqa: E731
    ids, texts = zip(*docs)
    write("documents", doc_id=list(ids), text=list(texts), lang=["en"] * len(ids), source=["s"] * len(ids), n_chars=[len(t or "") for t in texts])
    write("labels", doc_id=[x[0] for x in labels], quality=pa.array([1] * len(labels), pa.int32()), toxic=pa.array([x[2] for x in labels], pa.int32()))
    write("benchmark", item_id=[7], text=[item])
    return str(folder), dict(docs)


def test_each_stage_does_its_part(spark, sf_dir):
    folder, texts = sf_dir
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    left = collections.OrderedDict()
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        docs = docs.cache()
        left[name] = {r.doc_id: r for r in docs.collect()}
    kept = [set(x) for x in left.values()]
    assert kept[0] == {i for i in texts if not (i < 500 and i % 9 == 0)}
    assert {1001, 1002, 1003}.isdisjoint(kept[1]) and 1000 in kept[1] and {1101, 1102, 1103} <= kept[1]
    assert kept[1] - kept[2] == {1100}
    assert kept[2] == kept[3]
    last = left["pii"]
    assert last[1102].text is None and last[1101].text == texts[1101] and last[1104].text != texts[1104]
    assert last[1104].n_chars == len(last[1104].text)
    placed = P.run(spark, folder).collect()
    assert {r.doc_id for r in placed} == kept[3]


def test_toxic_rows_go_by_row_not_by_id(spark, tmp_path):
    docs, labels = corpus(500)
    toxic, clean = docs[9][1], "baran dotel kivos luwim mezun baran"
    rows = [(i, t, "s") for i, t, _ in docs] + [(None, toxic, "n"), (9, clean, "c"), (None, clean, "c"), (None, None, "c")]
    d = spark.createDataFrame(rows, "doc_id long, text string, `a source` string")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").where("doc_id <> 9").write.parquet(f"{tmp_path}/labels.parquet")
    left = P.drop_toxic(spark, d, str(tmp_path))
    assert left.columns == d.columns
    got = collections.Counter(tuple(r) for r in left.collect())
    assert got == collections.Counter(r for r in rows if r[2] != "n" and not (r[2] == "s" and r[0] % 9 == 0))


def test_columns_of_the_stages_own_names_stay(spark, tmp_path):
    item = " ".join(f"word{i}" for i in range(20))
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, "mail a.bc@mail.example.com now", "p", True, 30, 0.5), (2, item, "q", False, 5, None), (3, None, None, None, None, 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pii string, contaminated boolean, n_chars long, `a b` double")
    left = P.drop_contaminated(spark, docs, str(tmp_path))
    assert left.columns == docs.columns and sorted(tuple(r) for r in left.collect()) == [rows[0], rows[2]]
    out = P.hide_personal_data(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[1].text != rows[0][1] and got[1].n_chars == len(got[1].text) and got[1][2:4] == ("p", True)
    assert tuple(got[2]) == rows[1] and tuple(got[3]) == rows[2]


def test_empty_tables_pass_every_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir[0]}/documents.parquet").limit(0)
    for name, stage in P.STAGES:
        docs = stage(spark, docs, sf_dir[0])
        assert docs.count() == 0, name
