"""Words of texts without spaces: a dictionary found in the corpus, and the best path through its words.

Only runs of Chinese characters are looked at, and each different run once. All steps are joins, aggregates and column
expressions; the dictionary is a table, sent to all tasks only when the optimizer finds it small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.frames import entries
from tidemill.operators.vocabulary import HELD_ENTRIES, looked_up
from tidemill.session import written

RUN = "[一-鿿]+"
MAX_WORD = 4
UNIT = 1_000_000  # weights are whole numbers, so that equal paths are equal on every machine
UNKNOWN = -20 * UNIT  # weight of a character the dictionary lacks


def runs_of(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, run_no, run): maximal runs of Chinese characters in their order."""
    found = F.regexp_extract_all(F.col(text), F.lit(RUN), 0)
    return df.select(key, F.posexplode_outer(found).alias("run_no", "run")).filter("run IS NOT NULL")


def pieces(run: Column, longest: int) -> Column:
    """All substrings of up to ``longest`` characters."""
    places = F.sequence(F.lit(1), F.length(run))
    return F.flatten(F.transform(places, lambda i: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(longest), F.length(run) - i + 1)), lambda n: F.substring(run, i, n))))


def gram_counts(runs: DataFrame, longest: int) -> DataFrame:
    """(gram, n): how often each substring of runs occurs. ``runs`` has (run, times)."""
    return entries(runs, pieces(F.col("run"), longest), "gram", "times").groupBy("gram").agg(F.sum("times").alias("n"))


def branching(counts: DataFrame, side: str) -> DataFrame:
    """(gram, entropy): how freely the character before ("left") or after ("right") a gram varies; an end of a run
    counts as one more character."""
    rest = F.length("gram") - 1
    inner = F.expr("substring(gram, 1, length(gram) - 1)") if side == "right" else F.expr("substring(gram, 2)")
    longer = counts.filter(rest > 0).select(inner.alias("gram"), F.col("n").alias("m"))
    around = longer.groupBy("gram").agg(F.sum("m").alias("inside"), F.sum(F.col("m") * F.log("m")).alias("logs"))
    joined = counts.join(around, "gram", "left").na.fill({"inside": 0, "logs": 0.0})
    ends = F.col("n") - F.col("inside")
    logs = F.col("logs") + F.when(ends > 0, ends * F.log(ends)).otherwise(0.0)
    return joined.select("gram", F.round(F.log("n") - logs / F.col("n"), 9).alias("entropy"))


def corpus_dictionary(df: DataFrame, key: str, text: str, min_count: int = 5, min_cohesion: float = 10.0,
                      min_entropy: float = 1.0, longest: int = MAX_WORD) -> DataFrame:
    """(word, n, cohesion, entropy, weight), written: words found in the texts, and all single characters.

    A string of two to ``longest`` characters is a word when it occurs at least ``min_count`` times, at least
    ``min_cohesion`` times as often as its parts would meet by chance, at the weakest place, and when the characters on
    either side of it vary with an entropy of at least ``min_entropy``. The weight is the logarithm of its share.
    """
    found = runs_of(df, key, text).groupBy("run").agg(F.count("*").alias("times"))
    counts = written(gram_counts(found, longest + 1), "grams")
    total = counts.filter(F.length("gram") == 1).agg(F.sum("n").alias("total"))
    total = total.first()[0] or 0  # one number
    weight = F.round(F.log(F.col("n") / F.lit(float(total))) * UNIT).cast("bigint")
    often = counts.filter((F.col("n") >= min_count) & F.length("gram").between(2, longest))
    cuts = F.transform(F.sequence(F.lit(1), F.length("gram") - 1), lambda i: F.struct(
        F.substring(F.col("gram"), F.lit(1), i).alias("head"), F.substring(F.col("gram"), i + 1, F.length("gram")).alias("tail")))
    parts = often.select("gram", "n", F.explode(cuts).alias("cut")).select("gram", "n", "cut.*")
    heads = counts.select(F.col("gram").alias("head"), F.col("n").alias("n_head"))
    tails = counts.select(F.col("gram").alias("tail"), F.col("n").alias("n_tail"))
    chance = F.col("n").cast("double") * total / (F.col("n_head").cast("double") * F.col("n_tail"))
    cohesion = parts.join(heads, "head").join(tails, "tail").groupBy("gram").agg(F.min(chance).alias("cohesion"))
    sides = [branching(counts, side).withColumnRenamed("entropy", side) for side in ("left", "right")]
    free = sides[0].join(sides[1], "gram").select("gram", F.least("left", "right").alias("entropy"))
    words = often.join(cohesion, "gram").join(free, "gram").filter(
        (F.col("cohesion") >= min_cohesion) & (F.col("entropy") >= min_entropy))
    single = counts.filter(F.length("gram") == 1).select("gram", "n", F.lit(None).cast("double").alias("cohesion"),
                                                         F.lit(None).cast("double").alias("entropy"))
    every = words.select("gram", "n", "cohesion", "entropy").unionByName(single)
    return written(every.select(F.col("gram").alias("word"), "n", "cohesion", "entropy", weight.alias("weight")), "dictionary")


def best_path(longest: int) -> Column:
    """The lengths of the words that end at each place of a run on the best path to there.

    ``weights`` holds for each place and length the weight of the word that starts there, null where there is none. Of
    equal paths the one with the longer last word is taken.
    """
    def step(state: Column, end: Column) -> Column:
        def reached(n: Column) -> Column:
            weight = F.element_at("weights", ((end - n) * longest + n).cast("int"))
            return F.struct((F.element_at(state["scores"], -n) + weight).alias("score"), n.alias("size"))

        sizes = F.sequence(F.lit(1), F.least(F.lit(longest), end))
        best = F.array_max(F.filter(F.transform(sizes, reached), lambda x: x["score"].isNotNull()))
        kept = F.slice(F.concat(state["scores"], F.array(best["score"])), F.greatest(F.lit(1), F.size(state["scores"]) + 2 - longest),
                       F.lit(longest))
        return F.struct(kept.alias("scores"), F.concat(state["sizes"], F.array(best["size"])).alias("sizes"))

    start = F.struct(F.array(F.lit(0).cast("bigint")).alias("scores"), F.array().cast("array<int>").alias("sizes"))
    return F.aggregate(F.sequence(F.lit(1), F.length("run")), start, step, lambda s: s["sizes"])


def words_on_path(run: Column, sizes: Column) -> Column:
    def step(state: Column, end: Column) -> Column:
        size = F.element_at(sizes, end)
        word = F.substring(run, end - size + 1, size)
        return F.when(end == state["end"], F.struct((end - size).alias("end"), F.concat(F.array(word), state["words"]).alias("words"))
                      ).otherwise(state)

    start = F.struct(F.length(run).alias("end"), F.array().cast("array<string>").alias("words"))
    return F.aggregate(F.reverse(F.sequence(F.lit(1), F.length(run))), start, step, lambda s: s["words"])


def segment_runs(runs: DataFrame, dictionary: DataFrame, longest: int = MAX_WORD, held: int = HELD_ENTRIES) -> DataFrame:
    """(run, words): each different run cut where the sum of weights is largest.

    ``runs`` has a row for each different run. The ``held`` words of largest weight are looked up where a run is
    read, so that only rarer pieces of a run are rows of a join.
    """
    pieces_there = F.flatten(F.transform(F.sequence(F.lit(1), F.length("run")), lambda i: F.transform(
        F.sequence(F.lit(1), F.lit(longest)), lambda n: F.when(i + n - 1 <= F.length("run"), F.substring(F.col("run"), i, n)))))
    table = dictionary.select(F.col("word").alias("entry"), F.col("weight").alias("found"))
    first = table.orderBy(F.desc("found"), "entry").limit(held)
    found = looked_up(runs, "run", pieces_there, table, first, None, "found", unique=True)
    # As many entries as the run has places, so bounded by the run.
    weighed = F.transform("found", lambda w, at: F.coalesce(w, F.when(at % longest == 0, F.lit(UNKNOWN).cast("bigint"))))
    paths = found.select("run", weighed.alias("weights")).select("run", best_path(longest).alias("sizes"))
    return paths.select("run", words_on_path(F.col("run"), F.col("sizes")).alias("words"))


def segment(df: DataFrame, key: str, text: str, dictionary: DataFrame, longest: int = MAX_WORD, held: int = HELD_ENTRIES) -> DataFrame:
    """(key, words): the words of each text's runs in their order; a text without runs has none.

    Each different run is cut once; the ``held`` most frequent ones are looked up where a text is read, others by a join.
    """
    counted = written(runs_of(df, key, text).groupBy("run").agg(F.count("*").alias("n")), "runs")
    cut = segment_runs(counted.select("run"), dictionary, longest, held)
    table = written(cut.select(F.col("run").alias("entry"), F.array_join("words", " ").alias("found")), "segmented")
    often = counted.orderBy(F.desc("n"), "run").limit(held).select(F.col("run").alias("entry"))
    runs = F.regexp_extract_all(F.col(text), F.lit(RUN), 0)
    listed = looked_up(df, key, runs, table, table.join(written(often, "often"), "entry", "left_semi"), None, "runs")
    words = F.when(F.size("runs") > 0, F.split(F.array_join("runs", " "), " "))
    return df.select(key).join(listed.select(key, words.alias("words")), key, "left").withColumn(
        "words", F.coalesce("words", F.array().cast("array<string>")))
