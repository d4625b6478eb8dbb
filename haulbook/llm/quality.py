"""Quality rules whose thresholds come from mergeable quantile sketches per language and source. Native expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from haulbook.llm.common import WORDS, stored, text_or_empty

FEWEST_WORDS = 50       # base rule: fewer words fail,
REPEATED_PERCENT = 50   # and so does a larger share of words in repeated windows
REACH = 3               # a threshold lies so many quartile ranges beyond the quartile,
GROUP_ROWS = 200        # and comes from the merged sketch of the language, or of all, where a group has fewer rows
BITS = 7                # leading bits of a value that its bucket keeps: buckets are less than 1/64 of their value wide

#: The least distance between quartile and threshold, per mille, so that a group of alike texts rejects no ordinary one.
SLACK = {"word_length": 2000, "symbols": 50, "dup_lines": 400, "repeats": 300}
#: Measures with a lower threshold as well.
TWO_SIDED = {"word_length"}

# Fixed values of the base measures.
SYMBOLS = "[#*$%&|<>]"
SPACES = r"[\x20\x09-\x0D]+"


def _named(value: Column, body) -> Column:
    """``body`` of the value, which is computed once: a lambda holds it where a projection would repeat it."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column) -> Column:
    """Words in windows of three that the text holds twice or more: windows are sorted, equal neighbours found again by place."""
    threes = F.arrays_zip(words, F.slice(words, 2, F.size(words)), F.slice(words, 3, F.size(words))).cast("array<struct<a:string,b:string,c:string>>")
    windows = F.transform(threes, lambda x, i: F.struct(F.when(x.c.isNotNull(), F.concat_ws(" ", x.a, x.b, x.c)).alias("window"), i.alias("at")))

    def repeated(s):
        same = lambda k, other: F.get(s, k).window == F.get(s, other).window
        at = F.transform(F.sequence(F.lit(0), F.size(s) - 1), lambda k: F.when(same(k, k - 1) | same(k, k + 1), F.get(s, k).at))
        return F.aggregate(F.sort_array(F.filter(at, lambda x: x.isNotNull())),
                           F.struct(F.lit(0).alias("total"), F.lit(0).alias("upto")),
                           lambda a, x: F.struct((a.total + x + 3 - F.greatest(x, a.upto)).alias("total"), (x + 3).alias("upto")),
                           lambda a: a.total)

    return F.when(F.size(words) < 3, 0).otherwise(_named(F.sort_array(windows), repeated))


def text_measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the base measures, and per mille shares of each whole text; one row per row of ``docs``.

    n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words, base_failed; then word_length, symbols, dup_lines
    and repeats, in thousandths per word (per line for dup_lines), 0 for a text without words. A null text is empty.
    """
    text = text_or_empty()
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORDS))
    of_words = lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                                  _repeated_words(w).cast("long").alias("n_repeat_words"))
    of_lines = lambda x: F.struct(F.size(x).cast("long").alias("n_lines"),
                                  (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
    base = docs.select("doc_id", "lang", "source", F.transform(F.array(words), lambda w: of_words(w))[0].alias("of_words"),
                       F.transform(F.array(lines), of_lines)[0].alias("of_lines"),
                       F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    share = lambda part, whole: F.expr(f"case when {whole} > 0 then 1000 * {part} div {whole} else 0 end")
    return base.select(
        "doc_id", "lang", "source", "of_words.n_words", "of_words.word_chars", "n_symbols", "of_lines.n_dup_lines", "of_lines.n_lines",
        "of_words.n_repeat_words",
        F.expr(f"of_words.n_words < {FEWEST_WORDS} or 100 * of_words.n_repeat_words > {REPEATED_PERCENT} * of_words.n_words").alias("base_failed"),
        share("of_words.word_chars", "of_words.n_words").alias("word_length"), share("n_symbols", "of_words.n_words").alias("symbols"),
        share("of_lines.n_dup_lines", "of_lines.n_lines").alias("dup_lines"), share("of_words.n_repeat_words", "of_words.n_words").alias("repeats"))


def sketch(values: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Quantile sketches: keys, measure, bucket (its low end) and count. Values are whole numbers of 0 or more.

    A bucket keeps the leading ``BITS`` bits of a value. Counts of equal buckets add up, so sketches merge exactly, in any
    order, and a lost task that runs again gives the same one.
    """
    long = values.select(*keys, F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in measures))).alias("m"))
    cut = F.greatest(F.length(F.bin("m.value")) - BITS, F.lit(0))
    return (long.select(*keys, "m.measure", F.call_function("shiftleft", F.call_function("shiftright", F.col("m.value"), cut), cut).alias("bucket"))
            .groupBy(*keys, "measure", "bucket").agg(F.count("*").alias("count")))


def merged(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """The sketches of fewer keys, from the counts alone."""
    return sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("count").alias("count"))


def quartile_bounds(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """keys, rows, and <measure>_low and <measure>_high: the thresholds of each group."""
    by = [*keys, "measure"]
    listed = ", ".join(by)
    cum = sketches.select(*by, "bucket", F.expr(f"sum(count) over (partition by {listed} order by bucket)").alias("upto"),
                          F.expr(f"sum(count) over (partition by {listed})").alias("rows"))
    at = lambda k: F.min(F.when(4 * F.col("upto") >= k * F.col("rows"), F.col("bucket")))
    quartiles = cum.groupBy(*by).agg(F.max("rows").alias("rows"), at(1).alias("q1"), at(3).alias("q3"))
    out = []
    for name, slack in SLACK.items():
        of = F.when(F.col("measure") == name, F.greatest(REACH * (F.col("q3") - F.col("q1")), F.lit(slack)))
        out.append(F.max(F.col("q3") + of).alias(f"{name}_high"))
        if name in TWO_SIDED:
            out.append(F.max(F.col("q1") - of).alias(f"{name}_low"))
    return quartiles.groupBy(*keys).agg(F.max("rows").alias("rows"), *out)


def thresholds(measures: DataFrame) -> DataFrame:
    """lang, source and the thresholds that hold for them, with ``level``: source, language or all.

    Texts that fail the base rule are not counted. A group below ``GROUP_ROWS`` rows takes the thresholds of its
    language, and a language below takes those of all texts; null is a language and a source of its own.
    """
    fine = stored(sketch(measures.where(~F.col("base_failed")), ["lang", "source"], list(SLACK)))
    groups = quartile_bounds(fine, ["lang", "source"])
    bounds = [c for c in groups.columns if c.endswith(("_low", "_high"))]
    packed = lambda df, name, keys: df.select(*(F.col(k).alias(f"{name}_{k}") for k in keys),
                                              F.struct(F.lit(name).alias("level"), "rows", *bounds).alias(name))
    languages = packed(quartile_bounds(merged(fine, ["lang"]), ["lang"]), "language", ["lang"])
    everything = packed(quartile_bounds(merged(fine, []), []), "all", [])
    both = (packed(groups, "source", ["lang", "source"]).alias("g")
            .join(languages, F.col("source_lang").eqNullSafe(F.col("language_lang")), "left").join(F.broadcast(everything), F.lit(True), "left"))
    chosen = F.when(F.col("source.rows") >= GROUP_ROWS, F.col("source")).when(F.col("language.rows") >= GROUP_ROWS, F.col("language")).otherwise(F.col("all"))
    return both.select(F.col("source_lang").alias("lang"), F.col("source_source").alias("source"), chosen.alias("chosen")).select("lang", "source", "chosen.*")


def verdicts(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, the measures, base_failed, kept, level and the reasons of a rejection.

    A text that passes the base rule stays if each measure lies within the thresholds of its language and source. The
    measures are read from the texts once and stored; sketches, thresholds and verdicts read the stored numbers. A hot
    source is counted by its buckets before any shuffle. Null and empty texts fail the base rule; repeated rows and
    ids are each judged; other columns of ``docs`` are not read; an empty table gives an empty result.
    """
    measures = stored(text_measures(docs))
    limits = stored(thresholds(measures))
    limits = limits.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), *[c for c in limits.columns if c not in ("lang", "source", "rows")])
    joined = measures.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    rules = [F.when(F.col(m) > F.col(f"{m}_high"), F.lit(f"{m} high")) for m in SLACK]
    rules += [F.when(F.col(m) < F.col(f"{m}_low"), F.lit(f"{m} low")) for m in SLACK if m in TWO_SIDED]
    reasons = F.array_compact(F.array(F.when(F.col("base_failed"), F.lit("base")), *(F.when(~F.col("base_failed"), r) for r in rules)))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (F.size(reasons) == 0).alias("kept"), "level", reasons.alias("reasons"))


def quality_report(docs: DataFrame) -> DataFrame:
    return verdicts(docs).drop("level", "reasons")

