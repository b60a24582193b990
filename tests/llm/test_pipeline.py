"""The pipeline's stages over planted rows; the registered queries."""

import __spark_entry__ as E
import corpus_pipeline
from conftest import SF_SMALL

from nimbus.llm import toxicity

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, id long, key string, h1 long, t1 string, "
        "stays string, comp long, score string, x double")


def test_one_query_for_each_operator():
    names = {q.split("_")[0] for q in E.queries() if q.startswith("op")}
    assert names == {f"op{n}" for n in range(1, 14)} and "pipeline" in E.queries()


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]


def test_run_packs_what_the_stages_keep(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = corpus_pipeline.run(spark, SF_SMALL)
    kept = {r.doc_id for r in out.select("doc_id").distinct().collect()}
    every = {r.doc_id for r in docs.select("doc_id").collect()}
    assert kept < every and len(kept) > 0.6 * len(every)
    pieces = out.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert all(r["sum(length)"] == r["max(doc_tokens)"] for r in pieces)


def _tables(spark, to, rows):
    """A folder with ``rows`` as documents, under extra columns named as the stages' own are."""
    rest = (7, "k", 1, "t", "s", 2, "high", 0.5)
    docs = [(i, t, "en", "web", None if t is None else len(t), *rest) for i, t in rows]
    spark.createDataFrame(docs, DOCS).write.parquet(f"{to}/documents.parquet")
    spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog near the quiet river bank today")], "item_id long, text string"
                          ).write.parquet(f"{to}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i, _ in rows if i is not None], "doc_id long, quality int, toxic int").write.parquet(f"{to}/labels.parquet")
    return to


def _words(seed, n):
    return " ".join(f"w{(seed * 7919 + k * k * 31 + k) % 100_003}" for k in range(n))


def test_stages_on_rows_out_of_the_ordinary(spark, tmp):
    """Nulls, empty and very long texts, ties, repeated rows and clashing names: each stage against what must be left."""
    plain, long = _words(1, 60), _words(2, 60_000)
    near = plain.replace(plain.split()[-1], "other")
    leak = _words(3, 40) + " the quick brown fox jumps over the lazy dog near the quiet river bank today " + _words(4, 40)
    secret = _words(5, 40) + " password=hG7kQ2xP9vL4 " + _words(6, 40)
    rows = [(1, plain), (1, plain), (2, near), (3, None), (4, ""), (4, ""), (None, plain), (None, None), (5, long), (6, long + " end"),
            (7, leak), (8, secret), (9, _words(8, 50)), (9, _words(9, 50)), (-3, "one"), (10, "  \t ")]
    sf = _tables(spark, tmp, rows)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{sf}/{k}")
        docs = spark.read.parquet(f"{sf}/{k}")
        left[name] = docs.collect()

    def texts(name):
        return sorted(((r.doc_id, r.text) for r in left[name]), key=str)
    assert texts("toxicity") == sorted(rows, key=str)
    gone = [(1, plain), (2, near), (6, long + " end")]                    # copies and near copies of rows that stay
    alone = list(rows)
    for r in gone:
        alone.remove(r)
    assert texts("near_duplicates") == sorted(alone, key=str)
    alone.remove((7, leak))
    assert texts("decontamination") == sorted(alone, key=str)
    assert [i for i, _ in texts("secrets")] == [i for i, _ in sorted(alone, key=str)]
    marked = next(r for r in left["secrets"] if r.doc_id == 8)
    assert "hG7kQ2xP9vL4" not in marked.text and marked.n_chars == len(marked.text)
    assert [t for i, t in texts("secrets") if i != 8] == [t for i, t in sorted(alone, key=str) if i != 8]
    assert all((r.id, r.key, r.h1, r.t1, r.stays, r.comp, r.score, r.x) == (7, "k", 1, "t", "s", 2, "high", 0.5) for r in left["secrets"])
    pieces = left["packing"]
    whole = {}
    for r in pieces:
        whole.setdefault(r.doc_id, []).append(r.length)
    assert set(whole) == {i for i, _ in alone}
    assert sum(whole[3]) == 1 and sum(whole[-3]) >= 2                     # a null text is the end mark alone


def test_run_over_an_empty_table(spark, tmp):
    sf = _tables(spark, tmp, [])
    out = corpus_pipeline.run(spark, sf)
    assert out.count() == 0 and {"doc_id", "start", "length", "sequence_id"} <= set(out.columns)


def test_toxicity_learns_beside_columns_of_any_name(spark):
    rows = [(i, f"{'idiot moron' if i % 3 == 0 else 'good day'} {_words(i, 20)}", i, "w", i % 2, 9.0) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id long, word string, toxic int, score double")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    out = toxicity.drop_toxic(docs, toxicity.learn(docs, labels))
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} >= {i for i in range(60) if i % 3}
