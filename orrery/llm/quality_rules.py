"""Quality rules: base counts of a text and its divergence from its language's reference histograms.

References come from all documents: for each language the counts of character classes and of its most
common short words. A document is kept if its base rules hold and the Jensen-Shannon distances (base 2,
0 to 1) of its own two histograms from the reference of its language stay under the thresholds; texts
shorter than a guard aren't compared by that histogram. Only DataFrame functions are used.

Few words scatter about their reference, so the words' threshold falls with the length, as
sqrt(``word_scatter`` / (words + ``guard_words``)), down to ``most_word_distance``. The scatter was set on
labelled texts of sf0.1 with even ids (1,578 of quality 1 reach 12.99 at most), the README counts what each
rule catches and loses. A group of mixed languages has ``most_mixed_distance`` instead, as no text is like the mixture.

Defined results: null, empty or blank text has zero counts and fails the base rules; a null language,
or one with fewer than ``least_docs`` documents, is compared with the characters of all documents, and
its common words only where there are that many; repeated rows are judged each; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orrery.llm.shared import Workspace, few, task_count

SPACE = "[\\x20\\x09-\\x0D]+"
#: Character classes by what is left of a text without other characters; lower-case and the rest follow from the length.
CLASSES = {"upper": "[^A-Z]+", "digit": "[^0-9]+", "stop": "[^.,;:!?'\"()-]+", "symbol": "[^#*$%&|<>]+", "beyond": "[\\x00-\\x7F]+"}
ANY = "*"


def let(value: Column, body) -> Column:
    """body(value) with the value computed once a row."""
    return F.transform(F.array(value), body)[0]


def word_array(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def repeated_window_words(words: Column, n: int = 8) -> Column:
    """Words inside n-word windows that occur twice or more in the same array."""

    def covered(hashes: Column) -> Column:
        def over(s: Column) -> Column:
            twice = F.filter(s, lambda x, j: F.equal_null(F.get(s, j - 1)["h"], x["h"]) | F.equal_null(F.get(s, j + 1)["h"], x["h"]))
            places = F.array_sort(F.transform(twice, lambda x: x["i"]))
            zero = F.struct(F.lit(0).alias("total"), F.lit(0).alias("end"))
            return F.aggregate(places, zero, lambda a, p: F.struct((a["total"] + n - F.greatest(F.lit(0), a["end"] - p)).alias("total"), (p + n).alias("end")), lambda a: a["total"])

        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(pairs, over))

    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.xxhash64(F.slice(words, i, n)))
    return F.when(F.size(words) <= n, F.lit(0)).otherwise(let(hashes, covered))


def common_words(ws: Workspace, docs: DataFrame, per_language: int = 24, longest: int = 5) -> DataFrame:
    """(lang, words): the most frequent words of at most ``longest`` letters of every language, and ANY for all."""
    short = docs.select(
        F.coalesce("lang", F.lit(ANY)).alias("lang"),
        F.explode(F.transform(F.filter(word_array(F.col("text")), lambda w: F.char_length(w) <= longest), lambda w: F.lower(w))).alias("word"),
    ).where(F.col("word").rlike("^\\p{L}+$"))
    counts = ws.save(short.groupBy("lang", "word").agg(F.count("*").alias("n")), "words")
    total = counts.groupBy("word").agg(F.sum("n").alias("n")).select(F.lit(ANY).alias("lang"), "word", "n")
    ranked = counts.where(F.col("lang") != ANY).unionByName(total)
    # Each partition gives a language's best words; shares of the partitions are ranked before all of them, so no task reads every partition's.
    shares = 1 + int(task_count(docs.sparkSession) ** 0.5) // 2
    ranked = ranked.withColumn("share", F.spark_partition_id() % shares)
    for keys in (["lang", "share"], ["lang"]):
        by = Window.partitionBy(*keys).orderBy(F.desc("n"), "word")
        ranked = ranked.withColumn("place", F.row_number().over(by)).where(F.col("place") <= per_language)
    return ranked.groupBy("lang").agg(F.array_sort(F.collect_list("word")).alias("words"))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, base 2, of two arrays of counts; null if either has no mass."""

    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)

    def half(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    def distance(n: Column) -> Column:
        terms = F.zip_with(p, q, lambda a, b: let(F.struct((a / n["p"]).alias("a"), (b / n["q"]).alias("b")), lambda t: half(t["a"], (t["a"] + t["b"]) / 2) + half(t["b"], (t["a"] + t["b"]) / 2)))
        return F.when((n["p"] > 0) & (n["q"] > 0), F.sqrt(F.greatest(F.lit(0.0), total(terms) / 2)))

    return let(F.struct(total(p).alias("p"), total(q).alias("q")), distance)


def text_features(docs: DataFrame, lists: DataFrame, any_words: list[str], n: int = 8, longest: int = 5) -> DataFrame:
    """Counts and histograms of every text; lists: (lang, words), a row a language; any_words: for texts of none of them."""
    text = F.coalesce("text", F.lit(""))
    docs = docs.join(few(lists), "lang", "left").withColumn("own", F.when(F.col("words").isNull(), F.lit(ANY)).otherwise(F.col("lang")))
    docs = docs.withColumn("words", F.coalesce("words", F.array(*[F.lit(w) for w in any_words]).cast("array<string>")))

    def mark(place: Column) -> Column:
        return F.chr(place + 64)

    def of_words(words: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit("[^\\x20\\x09-\\x0D]")))
        short = F.transform(F.filter(words, lambda w: F.char_length(w) <= longest), lambda w: F.lower(w))
        places = F.filter(F.transform(short, lambda w: F.array_position("words", w)), lambda k: k > 0)
        coded = F.array_join(F.transform(places, mark), "")
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeated_window_words(words, n).cast("long").alias("n_repeat_words"),
            coded.alias("coded"),
        )

    left = {k: F.char_length(F.regexp_replace(text, F.lit(v), F.lit(""))).cast("long").alias(k) for k, v in CLASSES.items()}
    out = docs.select("doc_id", "own", "words", F.char_length(text).cast("long").alias("chars"), let(word_array(text), of_words).alias("w"), *left.values())
    hist = F.transform("words", lambda _, k: (F.char_length("w.coded") - F.char_length(F.replace("w.coded", mark(k + 1), F.lit("")))).cast("double"))
    rest = F.col("chars") - F.col("upper") - F.col("digit") - F.col("stop") - F.col("symbol") - F.col("beyond")
    space = F.col("chars") - F.col("w.word_chars")
    return out.select(
        "doc_id",
        "own",
        "chars",
        *[F.col(f"w.{c}").alias(c) for c in ("n_words", "word_chars", "n_dup_lines", "n_repeat_words")],
        F.col("symbol").alias("n_symbols"),
        F.array(*[x.cast("double") for x in (rest - space, space, F.col("upper"), F.col("digit"), F.col("stop"), F.col("symbol"), F.col("beyond"))]).alias("char_hist"),
        F.concat(hist, F.array((F.col("w.n_words") - F.char_length("w.coded")).cast("double"))).alias("word_hist"),
    )


def _mean(column: str, size: int) -> list[Column]:
    return F.array(*[F.coalesce(F.sum(F.get(column, F.lit(k))), F.lit(0.0)) for k in range(size)])


def judge_quality(
    docs: DataFrame,
    least_words: int = 20,
    most_repeat_percent: int = 30,
    window: int = 8,
    most_char_distance: float = 0.30,
    most_word_distance: float = 0.25,
    word_scatter: float = 14.0,
    most_mixed_distance: float = 0.60,
    guard_chars: int = 200,
    guard_words: int = 50,
    least_docs: int = 20,
    per_language: int = 24,
) -> DataFrame:
    """One row a document: base counts, distances from the references, base_failed and kept."""
    spark = docs.sparkSession
    ws = Workspace(spark, "quality")
    docs = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    lists = ws.save(common_words(ws, docs, per_language), "lists")
    any_words = [w for r in lists.where(F.col("lang") == ANY).collect() for w in r["words"]]  # one row
    features = ws.save(text_features(docs, lists.where(F.col("lang") != ANY), any_words, window), "features")
    size = per_language + 1
    sums = [_mean("char_hist", 7).alias("char_ref"), _mean("word_hist", size).alias("word_ref"), F.count("*").alias("docs")]
    each = features.withColumn("word_hist", F.concat(F.slice("word_hist", 1, F.size("word_hist") - 1), F.array_repeat(F.lit(0.0), F.lit(size) - F.size("word_hist")), F.slice("word_hist", -1, 1)))
    refs = ws.save(each.groupBy("own").agg(*sums), "refs")
    whole = features.agg(F.lit(None).cast("string").alias("own"), sums[0])
    whole = whole.withColumn("join", F.lit(1))
    # Languages with few documents lend no reference of their own for characters; their words stay theirs.
    refs = refs.withColumn("join", F.lit(1)).join(whole.select("join", F.col("char_ref").alias("all_ref")), "join")
    refs = refs.select("own", F.when((F.col("docs") >= least_docs) & (F.col("own") != ANY), F.col("char_ref")).otherwise(F.col("all_ref")).alias("char_ref"), F.col("word_ref"), (F.col("docs") >= least_docs).alias("firm"))
    out = each.join(few(ws.save(refs, "references")), "own", "left")  # a row a language
    out = out.withColumn("char_distance", F.when(F.col("chars") >= guard_chars, js_distance(F.col("char_hist"), F.col("char_ref"))))
    out = out.withColumn("word_distance", F.when((F.col("n_words") >= guard_words) & F.col("firm"), js_distance(F.col("word_hist"), F.col("word_ref"))))
    failed = (F.col("n_words") < least_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * most_repeat_percent)
    scatter = F.greatest(F.lit(most_word_distance), F.sqrt(F.lit(word_scatter) / (F.col("n_words") + guard_words)))
    most_words = F.when(F.col("own") == ANY, F.lit(most_mixed_distance)).otherwise(scatter)
    near = (F.coalesce("char_distance", F.lit(0.0)) <= most_char_distance) & (F.coalesce("word_distance", F.lit(0.0)) <= most_words)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & near).alias("kept"), "char_distance", "word_distance")
