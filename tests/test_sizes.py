"""What keeps queries within their limits on large tables."""

from pyspark.sql import functions as F

from dockmill.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_extracts_are_cleaned_once(spark):
    assert plan(QUERIES["clean_extract"](spark, DATA)).count("transform_values(") == 1


def test_features_are_counted_over_arrays(spark):
    from dockmill.functions import shingles
    from dockmill.functions import text as t

    assert "ArrowEvalPython" in plan(QUERIES["both_features"](spark, DATA))
    odd = [None, "", "a b", "ab cd ef ab cd ef ab cd ef", "\u0130stanbul \u212aelvin K2 na\u00efve", "x" * 70000 + " yy zz ab"]
    df = spark.createDataFrame(list(enumerate(odd)), "k int, x string")
    for mode in ("words", "word-ngrams", "both"):
        got = df.select(t.features(F.col("x"), mode).alias("f"), shingles.feature_ids(F.col("x"), mode).alias("i")).collect()
        assert all((r.f is None and r.i is None) or (len(r.f) == len(r.i) == len(set(r.i))) for r in got)
        pairs = {p for r in got if r.f for p in zip(r.f, r.i, strict=True)}
        assert len(pairs) == len({f for f, _ in pairs}) == len({i for _, i in pairs})
    got = df.select(shingles.feature_counts(F.col("x")).alias("c"), F.size(t.features(F.col("x"), "both")).alias("n"), F.size(t.features(F.col("x"), "words")).alias("w")).collect()
    assert [(r.c.n, r.c.words) for r in got] == [(0, 0) if x is None else (r.n, r.w) for r, x in zip(got, odd, strict=True)]


def test_themes_are_no_keys_of_a_shuffle(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from dockmill.fixtures import Views

        assert "SortMergeJoin" not in plan(Views(spark, DATA).extracts())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_attributes_are_parsed_once(spark):
    shown = plan(QUERIES["clustering_texts"](spark, DATA))
    assert shown.count("Generate json_tuple(") == 1 and "get_json_object" not in shown


def test_trimmed_white_space_is_that_of_the_pattern(spark):
    from dockmill.functions import text as t

    cases = [f"{chr(i)}a{chr(i)}b{chr(i)}{chr(i)}" for i in range(0x3001) if chr(i).isspace() or i in (0xFEFF, 0x180E)] + ["", " \n", None, "\ufeffx"]
    df = spark.createDataFrame([(c,) for c in cases], "x string")
    space = t.SPACE
    got = df.select("x", t.trim_space(F.col("x")).alias("a"), F.regexp_replace("x", rf"^{space}+|{space}+\z", "").alias("b")).collect()
    assert all(r.a == r.b for r in got)


def test_words_are_compared_as_numbers(spark):
    shown = plan(QUERIES["word_jaccard"](spark, DATA))
    assert "ArrowEvalPython" in shown and "isnan" not in shown.lower()


def test_postings_of_a_block_stay_where_they_were_made(spark):
    from dockmill.operators.search_index import TextIndex

    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(600).select("id", F.concat(F.lit("text "), F.sha2(F.col("id").cast("string"), 256)).alias("text")).repartition(3)
        built = TextIndex.build(rows, F.col("text"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    files = built.postings.select("block", F.input_file_name().alias("file")).groupBy("block").agg(F.countDistinct("file").alias("n"))
    assert files.count() >= 10 and files.where("n > 1").count() == 0


def test_sets_that_resemble_no_other_are_not_stored(spark, monkeypatch):
    from dockmill.operators import similarity

    stored, write = [], similarity.materialize

    def seen(df, name):
        out = write(df, name)
        if {"f", "seq"} & set(out.columns):
            stored.append(out.count())
        return out

    monkeypatch.setattr(similarity, "materialize", seen)
    rows = [(k, [f"w{k}-{i}" for i in range(20)]) for k in range(50)] + [(k, [f"same{i}" for i in range(20)]) for k in (60, 61)]
    df = spark.createDataFrame(rows, "k long, f array<string>")
    assert [(r.a, r.b) for r in similarity.similar_pairs(df, "k", "f", 0.8).collect()] == [(60, 61)] and sum(stored) == 0
