"""Quality verdict from counting rules and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed word n-grams, one of trusted target texts and one of the raw corpus,
are counted over all documents. A document's score is the mean over its n-grams of
``log p_target - log p_raw``; a fixed threshold gives the verdict. Everything is built-in
expressions: counting is a map-side aggregate over ``buckets`` keys, the ratio table (``buckets``
doubles, whatever the corpus) enters the scoring scan as a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwatch.llm.common import texts, words_of

BUCKETS = 1 << 14          # hashed n-grams
SMOOTHING = 1.0            # added to every bucket's count
THRESHOLD = -0.25          # mean log ratio below which a document goes
# Fixed values of the counting rules.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "[#*$%&|<>]"
# A token of the language model: a run of letters and digits, or of other visible signs.
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"


def _tokens(text: str) -> Column:
    """Array of the tokens of a text."""
    return F.expr(f"regexp_extract_all(lower(`{text}`), '{TOKEN.replace(chr(92), chr(92) * 2)}', 0)")


def _bucket(gram: str, buckets: int) -> str:
    """Bucket number of a gram's hash: of a token's, or of its and the next one's."""
    return f"CAST(pmod({gram}, {buckets}) AS INT)"


def gram_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n`` over all texts' unigrams and bigrams; at most ``buckets`` rows leave a task.

    Without lambda functions, which Spark does not compile. Arrays are unfolded by the outer form: for the
    inner one Spark first filters by the array's size, for which it makes the tokens once more.
    """
    token = (texts(docs).select(_tokens("text").alias("t"))
             .select(F.expr("arrays_zip(t, slice(t, 2, size(t)))").alias("z"))
             .select(F.inline_outer("z").alias("a", "b")).where("a IS NOT NULL"))
    grams = token.select(F.expr(_bucket("xxhash64(a)", buckets)).alias("one"), F.expr(
        f"CASE WHEN b IS NOT NULL THEN {_bucket('xxhash64(xxhash64(a), xxhash64(b))', buckets)} END").alias("two"))
    return (grams.select(F.explode_outer(F.array("one", "two")).alias("bucket")).where("bucket IS NOT NULL")
            .groupBy("bucket").agg(F.count(F.lit(1)).alias("n")))


def ratio_table(target: DataFrame, raw: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row: ``llr``, an array of ``buckets`` doubles (all 0 when the target has no n-gram)."""
    t = gram_counts(target, buckets).withColumnRenamed("n", "t")
    r = gram_counts(raw, buckets).withColumnRenamed("n", "r")
    spark = raw.sparkSession
    each = (spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
            .join(t, "bucket", "left").join(r, "bucket", "left").na.fill(0, ["t", "r"]))
    row = each.agg(F.array_sort(F.collect_list(F.struct("bucket", "t", "r"))).alias("c"),
                   F.sum("t").alias("nt"), F.sum("r").alias("nr"))
    a, m = SMOOTHING, SMOOTHING * buckets
    return row.select(F.transform("c", lambda x: F.when(
        F.col("nt") > 0, F.log((x["t"] + a) / (F.col("nt") + m)) - F.log((x["r"] + a) / (F.col("nr") + m))
    ).otherwise(F.lit(0.0))).alias("llr"))


def quality_rules(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS,
                  threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: counts, ``llr``, ``base_failed`` and ``kept``.

    ``target`` holds the trusted texts (columns doc_id, text). Columns: doc_id, n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words (long), llr (double, mean log ratio; 0
    without a token or without target texts), base_failed, kept. A null text counts as empty, has
    no words and fails. Repeated rows give repeated results, an empty table gives none. Other
    columns of the inputs are not read.
    """
    base = texts(docs).select(
        "doc_id", "text", words_of("text").alias("w"), F.transform(_tokens("text"), lambda t: F.xxhash64(t)).alias("h"),
        F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    hashed = base.select(
        "doc_id", F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), "h",
        F.transform("w", lambda x: F.xxhash64(x)).alias("v"))
    # Hashes of the windows, from the words' by way of two and four words: every word is hashed once.
    both = "(a, b) -> xxhash64(a, b)"
    twos = hashed.withColumn("win", F.expr(f"zip_with(v, slice(v, 2, size(v)), {both})"))
    fours = twos.withColumn("win", F.expr(f"zip_with(win, slice(win, 3, size(win)), {both})"))
    windows = fours.withColumn("win", F.expr(
        f"zip_with(slice(win, 1, greatest(size(win) - {WINDOW - 1}, 0)), slice(v, {WINDOW}, size(v)), {both})")).drop("v")
    # Only a text that has a repeated window pays for sorting its windows.
    ordered = windows.withColumn("win", F.expr(
        "CASE WHEN size(array_distinct(win)) < size(win) "
        "THEN sort_array(transform(win, (v, i) -> struct(v AS v, i AS i))) END"))
    twice = ordered.withColumn("win", F.expr(
        "sort_array(transform(filter(win, (x, k) -> (k > 0 AND get(win, k - 1).v = x.v) "
        "OR (k + 1 < size(win) AND get(win, k + 1).v = x.v)), x -> x.i))"))
    counted = twice.withColumn("n_repeat_words", F.expr(
        f"coalesce(aggregate(zip_with(win, slice(win, 2, size(win)), "
        f"(a, b) -> least({WINDOW}, coalesce(b - a, {WINDOW}))), 0L, (s, x) -> s + x), 0L)"))
    table = ratio_table(target, docs, buckets).scalar()
    add = lambda gram: f"(s, g) -> s + get(table, {_bucket(gram, buckets)})"
    scored = counted.withColumn("table", table).withColumn("llr", F.expr(f"""
        CASE WHEN size(h) > 0 THEN
          aggregate(zip_with(slice(h, 1, size(h) - 1), slice(h, 2, size(h)), {both}),
                    aggregate(h, 0D, {add("g")}), {add("g")}) / (2 * size(h) - 1)
        ELSE 0D END"""))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr",
                         failed.alias("base_failed"), (~failed & (F.col("llr") >= threshold)).alias("kept"))
