import random
from collections import Counter

import corpus_pipeline
from kithra.llm import decontaminate, quality
from kithra.llm.q_data import word_tokenizer
from kithra.session import materialize

from .test_ngramjoin import brute, family


def table_folder(spark, tmp_path, documents):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    good = [(i, ". ".join(" ".join(word() for _ in range(8)) for _ in range(rng.randint(3, 30))), f"s{i % 3}") for i in range(150)]
    good += [(k, t, "s0") for k, t in family(rng, [word() for _ in range(80)], 12, 3, 200)]
    junk = [(300 + i, " ".join([word().upper() + "!!"] * 60), "s1") for i in range(60)]
    items = [(i, " ".join(word() for _ in range(30))) for i in range(4)]
    leaky = [(400 + i, good[i][1] + " " + items[i % 4][1] + " " + good[i + 20][1], None) for i in range(8)]
    odd = [(500, "", "s1"), (501, None, "s2"), (None, "no id here at all in this one", "s2"), (20, "a second text of key twenty stands here", "s0")]
    rows = good + junk + leaky + odd
    labels = [(k, 1, 0) for k, *_ in good if k % 2] + [(k, 0, 0) for k, *_ in junk if k % 2]
    documents(rows).drop("key", "size", "_source", "id").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), rows, {k for k, *_ in junk}, {k for k, *_ in leaky}


def test_stages_do_what_they_say(spark, tmp_path, documents):
    folder, rows, junk, leaky = table_folder(spark, tmp_path, documents)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = materialize(stage(spark, before, folder), "test")
        seen[name] = before, docs
        if name != "token ids":
            assert docs.columns == columns
    before, after = seen["quality"]
    kept = Counter(map(tuple, after.collect()))
    model = quality.train(before, spark.read.parquet(f"{folder}/labels.parquet"))
    assert kept == Counter(tuple(r)[:len(columns)] for r in quality.score(before, model).filter(f"score >= {quality.THRESHOLD}").collect())
    left = {r["doc_id"] for r in after.collect()}
    assert len(left & junk) <= 2 and len({k for k, *_ in rows} - junk - left) <= 3
    before, after = seen["near copies"]
    was = [(r["doc_id"], r["text"]) for r in before.collect()]
    component = brute(was, corpus_pipeline.NEAR_WIDTH, corpus_pipeline.NEAR_PERCENT)
    now = [r["doc_id"] for r in after.collect()]
    assert sorted(k for k in now if k is not None) == sorted(k for k, c in component.items() if k == c)
    assert now.count(None) == sum(k is None for k, _ in was)
    before, after = seen["decontamination"]
    assert {r["doc_id"] for r in before.collect()} - {r["doc_id"] for r in after.collect()} == leaky & {r["doc_id"] for r in before.collect()}
    before, after = seen["mixing"]
    times = Counter(r["doc_id"] for r in after.collect())
    assert set(times) <= {r["doc_id"] for r in before.collect()} and max(times.values()) <= 3
    before, after = seen["token ids"]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(word_tokenizer())
    sizes = Counter((r["doc_id"], len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1) for r in before.collect())
    assert Counter((r["doc_id"], r["n_tokens"]) for r in after.collect()) == sizes
    whole = Counter(map(tuple, corpus_pipeline.run(spark, folder).collect()))
    assert whole == Counter(map(tuple, after.collect()))


def test_decontamination_counts_all_texts(spark, tmp_path, monkeypatch):
    """The matrix whose leading vectors are sought has the passages of every document, however many there are."""
    spark.createDataFrame([(1, " ".join(f"item{i}" for i in range(30)))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.range(24_000).selectExpr("id doc_id", "concat('some words of text ', id) text")
    read, sketch = [], decontaminate.gram_sketch

    def counted(texts, *rest):
        read.append(texts.count())
        return sketch(texts, *rest)

    monkeypatch.setattr(decontaminate, "gram_sketch", counted)
    assert corpus_pipeline.drop_leaks(spark, docs, str(tmp_path)).count() == 24_000
    assert read == [24_000]


def test_empty_documents(spark, tmp_path, documents):
    folder, *_ = table_folder(spark, tmp_path, documents)
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).collect() == []


OWN_NAMES = ["_source", "_key", "_nth", "_copy", "copies", "_size", "size_", "size_d", "_told", "_row", "row", "col", "_label", "_text", "_doc",
             "_scored", "_score", "score", "component", "n", "key", "id", "text_", "_at", "_key_d", "target", "taken", "item_id", "n_shingles", "component_id"]


def test_extra_columns_keep_their_values(spark, tmp_path, documents):
    """Every stage takes columns of any name through, value by value; a row repeated very often is one document."""
    folder, rows, *_ = table_folder(spark, tmp_path, documents)
    plain = spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id is null or doc_id < 60 or doc_id >= 500")
    often = spark.range(10_000).selectExpr("777L doc_id", "'a row that stands ten thousand times in the table' text", "null lang", "'s1' source", "1L n_chars")
    plain = plain.unionByName(often.selectExpr(*[f"cast({c} as {t}) {c}" for c, t in plain.dtypes]))
    from pyspark.sql import functions as F

    docs = materialize(plain.select("*", *[F.concat(F.lit(f"{c}="), F.coalesce(F.xxhash64("doc_id", "text").cast("string"), F.lit("-"))).alias(c)
                                           for c in OWN_NAMES]), "wide")
    held = {tuple(r) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = materialize(stage(spark, docs, folder), "wide")
        assert after.columns == docs.columns, name
        got = after.collect()
        assert got and {tuple(r) for r in got} <= held, name
        if name == "near copies":
            assert sum(r["doc_id"] == 777 for r in got) == 1
        docs = after
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == docs.count()
