import corpus_pipeline
from quarry.llm.common import handoff
from quarry.llm.queries import QUERIES
from tests.llm.helpers import odd_documents
from tests.llm.test_jaccard import brute as jaccard_brute
from tests.llm.test_packing_bpe import check_packed
from tests.llm.test_suffixes import brute as suffix_brute

STAGES = dict(corpus_pipeline.STAGES)


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_registered():
    import __spark_entry__ as entry
    assert {"pipeline", *QUERIES} <= set(entry.queries())
    assert [n for n in range(1, 11) if sum(q.startswith(f"op{n}_") for q in QUERIES) != 1] == []


def test_stages_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    one = handoff(STAGES["toxicity"](spark, docs, sf), "t1")
    assert one.columns == columns and set(ids(one)) <= set(ids(docs))

    rows = [(r["doc_id"], r["text"]) for r in one.collect()]
    two = handoff(STAGES["ngram_jaccard"](spark, one, sf), "t2")
    assert two.columns == columns and ids(two) == sorted(i for i, _, c in jaccard_brute(rows, 5, 80) if i == c)

    rows = [(r["doc_id"], r["text"]) for r in two.collect()]
    three = handoff(STAGES["suffix_dedup"](spark, two, sf), "t3")
    assert three.columns == columns
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in three.collect()) == sorted((i, k.decode("utf-8", "ignore"), len(k.decode("utf-8", "ignore"))) for i, _, _, _, k in suffix_brute(rows))

    four = handoff(STAGES["pii"](spark, three, sf), "t4")
    assert four.columns == columns and ids(four) == ids(three)
    check_packed(STAGES["best_fit_packing"](spark, four, sf).collect(), four.select("doc_id", "text").collect())


def test_stages_on_odd_documents(spark, sf):
    docs = odd_documents(spark)
    two = handoff(STAGES["ngram_jaccard"](spark, docs, sf), "odd2")
    assert two.columns == docs.columns
    assert sorted(ids(two.where("doc_id is not null"))) == [1, 2, 3, 4, 5, 6, 7] and two.where("doc_id is null").count() == 1
    three = handoff(STAGES["suffix_dedup"](spark, two, sf), "odd3")
    assert three.columns == docs.columns and three.count() == 8
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0, name


def test_stages_keep_clashing_columns(spark, sf):
    """Columns named like the operators' results, or with odd names, pass all four stages as they are."""
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 60")  # a small fixture
    extra = {"score": F.col("doc_id") / 7, "kinds": F.concat(F.lit("k"), "doc_id"), "n_values": F.col("doc_id") * 2, "kept": F.lit("x"),
             "n_bytes": F.col("doc_id") + 1, "n_removed": F.lit(None).cast("string"), "a.b c": F.col("doc_id") + 3, "h": F.lit(True)}
    docs = docs.withColumns(extra)
    want = {r["doc_id"]: [r[c] for c in extra] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        new = handoff(stage(spark, docs, sf), f"clash-{name}")
        assert new.schema.names == docs.schema.names and dict(new.dtypes) == dict(docs.dtypes), name
        rows = new.collect()
        assert rows and all([r[c] for c in extra] == want[r["doc_id"]] for r in rows), name
        docs = new
    assert "sequence_id" in STAGES["best_fit_packing"](spark, docs, sf).columns
