"""Quality rules as weak supervision, in DataFrame functions only.

Each rule looks at one property of a text and votes good (+1), bad (-1) or
abstains (0).  No labels are used: expectation-maximisation over the counts of
vote patterns estimates how often each rule is right when it votes, and the
share of good documents.  A document is kept by the posterior probability that
it is good, so one stray rule does not reject it.

The patterns number 3 ** (number of rules) at most whatever the corpus, so their
counts are all that the driver sees.  The texts are read once: their measures
go to a table in the shared folder, from which votes are counted and results
returned.

Defined results: a null or blank text has no words, all counts 0 and fails the
base rule; every row of the input gives one row, repeated rows too; an empty
table gives an empty result; input columns named like an output are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockmill.plans.shared import materialize, spread

SPACE = " \t\n\x0b\f\r"
BAD_COST = 4.0
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

# Common function words of the corpus languages.
FUNCTION_WORDS = """
the of and to in a is that it for was on as with be by this are at or an from
de la le les et en un une des que qui dans pour est du au sur par
der die das und ist zu den von mit ein eine nicht im auf sich
el los las y del se con una por lo no es
""".split()


def measures(df: DataFrame, text: Column, keep: list[str], hashed=F.xxhash64) -> DataFrame:
    """The columns ``keep`` of ``df`` with the base measures and those that only the rules use (``__q_*``).

    Repeated words: start positions of the 3-word windows are sorted by a hash
    of the window, packed with the position into one long, so the sort is one of
    primitives; equal neighbours are then compared word by word.  In a text where
    neighbours have equal hashes and different words, the windows themselves are
    sorted instead.
    """
    out = df.select(*keep, F.coalesce(text, F.lit("")).alias("__q_text"))
    out = out.withColumn("__q_trim", F.trim(F.col("__q_text"), F.lit(SPACE)))
    out = out.withColumn("__q_words", F.when(F.col("__q_trim") == "", F.array().cast("array<string>")).otherwise(F.split("__q_trim", r"[\x20\x09-\x0D]+")))
    out = out.withColumn("n_words", F.size("__q_words").cast("long"))
    bits = F.coalesce(F.length(F.bin(F.col("n_words"))), F.lit(1))
    out = out.withColumn("__q_bits", bits)

    def window(i: Column) -> Column:
        words = F.col("__q_words")
        return hashed(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))

    out = out.withColumn("__q_at", F.when(F.col("n_words") >= 3, F.sequence(F.lit(0), F.size("__q_words") - 3)).otherwise(F.array().cast("array<int>")))
    out = out.withColumn("__q_sorted", F.sort_array(F.transform("__q_at", lambda i: F.call_function("shiftleft", window(i), F.col("__q_bits")).bitwiseOR(i.cast("long")))))

    high = lambda v: F.call_function("shiftrightunsigned", v, F.col("__q_bits"))
    low = lambda v, k: F.get(F.col("__q_words"), (v.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("__q_bits")) - 1)).cast("int") + k)

    def words_alike(x: Column, y: Column) -> Column:
        return (low(x, 0) == low(y, 0)) & (low(x, 1) == low(y, 1)) & (low(x, 2) == low(y, 2))

    def same(x: Column, y: Column) -> Column:
        """Two packed windows, one of which may be null, have the same words."""
        return (high(x) == high(y)) & words_alike(x, y)

    beside = lambda f, of: lambda x, j: F.coalesce(f(x, F.get(of, j - 1)) | f(x, F.get(of, j + 1)), f(x, F.get(of, j - 1)), f(x, F.get(of, j + 1)), F.lit(False))
    # Runs of equal hashes, which are few; what follows looks at them only.
    out = out.withColumn("__q_near", F.filter("__q_sorted", beside(lambda x, y: high(x) == high(y), F.col("__q_sorted"))))
    packed = F.col("__q_near")
    clash = F.size(F.filter(packed, lambda x, j: (high(x) == high(F.get(packed, j + 1))) & ~words_alike(x, F.get(packed, j + 1)))) > 0
    triple = lambda i: F.struct(*(F.get(F.col("__q_words"), i + k).alias(f"w{k}") for k in range(3)), i.cast("long").alias("at"))
    out = out.withColumn("__q_exact", F.when(clash, F.sort_array(F.transform("__q_at", triple))))
    alike = lambda x, y: (x.w0 == y.w0) & (x.w1 == y.w1) & (x.w2 == y.w2)
    exact = F.col("__q_exact")
    by_words = F.transform(F.filter(exact, beside(alike, exact)), lambda x: x["at"])
    by_hash = F.transform(F.filter(packed, beside(same, packed)), lambda x: x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("__q_bits")) - 1))
    out = out.withColumn("__q_twice", F.sort_array(F.when(exact.isNotNull(), by_words).otherwise(by_hash)))
    repeat = F.transform("__q_twice", lambda p, j: F.least(F.lit(3).cast("long"), F.coalesce(F.get(F.col("__q_twice"), j + 1) - p, F.lit(3).cast("long"))))

    lines = F.filter(F.split("__q_text", "\n"), lambda x: F.trim(x, F.lit(SPACE)) != "")
    out = out.withColumn("__q_line", lines)
    return out.select(
        *keep,
        "n_words",
        F.length(F.array_join("__q_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("__q_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("__q_line") - F.size(F.array_distinct("__q_line"))).cast("long").alias("n_dup_lines"),
        F.aggregate(repeat, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words"),
        F.size("__q_line").alias("__q_lines"),
        F.regexp_count("__q_text", F.lit(r"[A-Z]")).alias("__q_upper"),
        F.regexp_count("__q_text", F.lit(r"[0-9]")).alias("__q_digits"),
        F.size(F.array_intersect("__q_words", F.array(*[F.lit(w) for w in FUNCTION_WORDS]))).alias("__q_function"),
        F.regexp_count("__q_text", F.lit(r"[.!?](?=\s|$)")).alias("__q_stops"),
    )


def rules() -> dict[str, Column]:
    """Name to vote: +1 good, -1 bad, 0 none."""
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))

    def vote(x: Column, good: Column, bad: Column) -> Column:
        return F.when(F.col("n_words") == 0, -1).when(good(x), 1).when(bad(x), -1).otherwise(0)

    return {
        "word_length": vote(F.col("word_chars") / words, lambda x: x.between(3, 9), lambda x: (x < 2.5) | (x > 12)),
        "symbols": vote(F.col("n_symbols") / words, lambda x: x <= 0.05, lambda x: x > 0.25),
        "dup_lines": vote(F.col("n_dup_lines") / F.greatest(F.col("__q_lines"), F.lit(1)), lambda x: x <= 0.1, lambda x: x > 0.3),
        "repeats": vote(F.col("n_repeat_words") / words, lambda x: x <= 0.15, lambda x: x > 0.4),
        "capitals": vote(F.col("__q_upper") / chars, lambda x: x <= 0.15, lambda x: x > 0.4),
        "digits": vote(F.col("__q_digits") / chars, lambda x: x <= 0.1, lambda x: x > 0.3),
        "function_words": F.when(F.col("n_words") < 20, 0).when(F.col("__q_function") >= 4, 1).when(F.col("__q_function") == 0, -1).otherwise(0),
        "sentences": vote(F.col("__q_stops") / words, lambda x: x.between(0.01, 0.3), lambda x: (x < 0.001) | (x > 0.6)),
    }


def pattern(votes: dict[str, Column]) -> Column:
    """The votes as one number, base 3."""
    return sum(((v + 1).cast("int") * 3**j for j, v in enumerate(votes.values())), F.lit(0))


def fit(counts: dict[int, int], n_rules: int, *, rounds: int = 200, tolerance: float = 1e-9) -> tuple[float, list[tuple[float, float]]]:
    """Expectation-maximisation over pattern counts: (share of good ones, accuracies).

    A rule has two accuracies: how often its vote is right about good documents
    and about bad ones.  Given the class, rules err independently; an abstention
    says nothing.  Accuracies start at 0.95 and 0.4, since most rules catch one
    kind of bad text each, and a prior of ten votes each keeps a rule that seldom
    votes near its start.  A rule is taken to be better than chance (the two add
    up to 1.05 at least), which also settles which class is the good one.
    """
    prior, accuracy = 0.8, [(0.95, 0.4)] * n_rules
    votes = [([p // 3**j % 3 - 1 for j in range(n_rules)], n) for p, n in sorted(counts.items())]
    for _ in range(rounds if votes else 0):
        right_good, cast_good, right_bad, cast_bad = [9.5] * n_rules, [10.0] * n_rules, [4.0] * n_rules, [10.0] * n_rules
        good, total = 8.0, 10.0
        for v, n in votes:
            q = 1 / (1 + math.exp(-logit(prior, accuracy, v)))
            good, total = good + q * n, total + n
            for j, x in enumerate(v):
                if x:
                    cast_good[j] += q * n
                    cast_bad[j] += (1 - q) * n
                    right_good[j] += q * n * (x > 0)
                    right_bad[j] += (1 - q) * n * (x < 0)
        new = []
        for j in range(n_rules):
            a = min(0.999, max(0.5, right_good[j] / cast_good[j]))
            new.append((a, min(0.999, max(1.05 - a, right_bad[j] / cast_bad[j]))))
        moved = max(abs(x - y) for a, b in zip(new, accuracy, strict=True) for x, y in zip(a, b, strict=True))
        prior, accuracy = min(0.99, max(0.01, good / total)), new
        if moved < tolerance:
            break
    return prior, accuracy


def weights(accuracy: tuple[float, float]) -> tuple[float, float]:
    """What a good and a bad vote of a rule add to the log odds of being good."""
    a, b = accuracy
    return math.log(a / (1 - b)), math.log((1 - a) / b)


def logit(prior: float, accuracy: list[tuple[float, float]], votes: list[int]) -> float:
    return math.log(prior / (1 - prior)) + sum(weights(a)[x < 0] for x, a in zip(votes, accuracy, strict=True) if x)


def judge(df: DataFrame, text: Column, *, carry: list[str] | None = None, bad_cost: float = BAD_COST) -> DataFrame:
    """``df`` with the base measures, ``base_failed``, ``p_good`` and ``kept``.

    A bad document that is kept costs ``bad_cost`` times as much as a good one
    that is lost, so a document is kept where its posterior is at least
    ``bad_cost / (1 + bad_cost)``.
    ``carry``: columns to go along (all by default); fewer make the table that
    is written between the two steps smaller.
    """
    keep = [c for c in (df.columns if carry is None else carry) if c not in {*MEASURES, "base_failed", "p_good", "kept"}]
    measured = measures(df, text, keep)
    votes = rules()
    voted = materialize(measured.withColumns({f"__v_{k}": v.cast("tinyint") for k, v in votes.items()}).drop(*[c for c in measured.columns if c.startswith("__q_")]), "measures")
    cast = {k: F.col(f"__v_{k}") for k in votes}
    counts = dict(voted.groupBy(pattern(cast).alias("pattern")).count().collect())  # 3 ** rules at most
    prior, accuracy = fit(counts, len(votes))
    score = F.lit(math.log(prior / (1 - prior)))
    for k, a in zip(votes, accuracy, strict=True):
        good, bad = weights(a)
        score = score + F.when(cast[k] > 0, good).when(cast[k] < 0, bad).otherwise(0.0)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = voted.withColumn("base_failed", failed).withColumn("p_good", 1 / (1 + F.exp(-score)))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= bad_cost / (1 + bad_cost))).select(*keep, *MEASURES, "base_failed", "p_good", "kept")


def op10_quality(spark, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document; a null text has no words and fails."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return judge(docs, F.col("text"), carry=["doc_id"]).select("doc_id", *MEASURES, "base_failed", "kept", "p_good")
