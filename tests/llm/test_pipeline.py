"""The pipeline's stages against brute force on the smallest tables."""

from test_operators import check_packing, removed

from pyspark.sql import functions as F

import corpus_pipeline
from tidewell.llm import op4_pii
from tidewell.session import settle


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = kept[name] = settle(stage(spark, docs, sf_dir), name)
        if name != "packing":
            assert docs.columns == kept["documents"].columns
    ids = {n: {r["doc_id"]: r["text"] for r in f.select("doc_id", "text").collect()} for n, f in kept.items() if n != "packing"}
    assert set(ids["language"]) == {i for i, t in ids["documents"].items() if t and any(c.isalpha() for c in t)}
    assert set(ids["near_duplicates"]) <= set(ids["language"]) and len(ids["near_duplicates"]) < len(ids["language"])
    rows = sorted(ids["near_duplicates"].items())
    for (i, text), (_, n_removed, left) in zip(rows, removed(rows)):
        assert ids["repeated_passages"].get(i, "") == (left if n_removed else text)
    for i, text in ids["personal_data"].items():
        assert not op4_pii.base_spans(text) or op4_pii.base_spans(ids["repeated_passages"][i])
    used, least = check_packing(kept["personal_data"], kept["packing"])
    assert used <= least + 2


FOREIGN = {
    "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
    "el": "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα.",
    "zh": "人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心,并应以兄弟关系的精神相对待。",
    "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
    "tr": "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler.",
}


def test_language_stage_rejects_what_no_learned_language_fits(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = {1_000_000 + i: text for i, text in enumerate(FOREIGN.values())}
    one = docs.where("lang = 'de' and length(text) > 400").orderBy("doc_id").first()["text"]
    mostly = one[:100] + " " + FOREIGN["ru"] * 5
    partly = one + " " + FOREIGN["ru"][:40]
    ids |= {2_000_000: mostly, 2_000_001: partly}
    more = spark.createDataFrame([(i, t, None, "x", len(t)) for i, t in ids.items()], docs.schema)
    kept = {r["doc_id"] for r in corpus_pipeline.by_language(spark, docs.unionByName(more), sf_dir).collect()}
    clean = {r["doc_id"] for r in docs.collect() if r["text"] and any(c.isalpha() for c in r["text"])}
    assert kept == clean | {2_000_001}


def test_further_columns_stay_as_they_are(spark, sf_dir):
    """Columns named like results of the operators, null texts and ids, repeated rows, and an empty table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 60")
    names = ["score", "fit", "masked", "n_words", "n_removed", "kept_text", "lang_pred", "lang_spans", "k", "t", "row", "rest", "body"]
    more = docs.unionByName(docs.where("doc_id < 3")).unionByName(spark.createDataFrame([(None, "the mail of the office is a.b@c.de and no more of it", "en", "s", 3), (900, None, "en", "s", 0), (901, "", None, "s", 0)], docs.schema))
    for name in names:
        more = more.withColumn(name, F.concat(F.lit(f"{name}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    kept = more
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = settle(stage(spark, kept, sf_dir), name)
        assert kept.columns == more.columns
        rows = kept.collect()
        assert rows and all(r[n] == f"{n}:{'none' if r['doc_id'] is None else r['doc_id']}" for r in rows for n in names)
        assert {900, 901}.isdisjoint(r["doc_id"] for r in rows)
    assert next(r["text"] for r in rows if r["doc_id"] is None) == "the mail of the office is <EMAIL> and no more of it"
    empty = more.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        empty = settle(stage(spark, empty, sf_dir), name)
        assert empty.count() == 0
