"""Quality rules with thresholds that adapt to language and source.

Only DataFrame functions. The measures of a document are integers (shares in thousandths), so a sketch of their
distribution has a bounded number of buckets and is the same under any partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tunequorum.llm.text import let, words
from tunequorum.runtime import durable

SYMBOLS = "[#*$%&|<>]"
#: Words of a window; the hashes below are built for eight.
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30


def _repeat_words(word_list: Column) -> Column:
    """Words inside windows of WINDOW words that the text has twice or more.

    Windows are compared by their 64-bit hash within one text.
    """
    n = F.size(word_list)

    def joined(hash_list: Column, step: int) -> Column:
        """Hash of the runs that start at each place and at the place ``step`` later."""
        later = F.slice(hash_list, F.lit(step + 1), F.greatest(F.size(hash_list) - step, F.lit(0)))
        return F.zip_with(hash_list, later, lambda a, b: F.xxhash64(a, b))

    def hashes() -> Column:
        pairs, starts = joined(word_list, 1), F.greatest(n - (WINDOW - 1), F.lit(0))
        return let(pairs, lambda p: let(joined(p, 2), lambda f: F.slice(joined(f, 4), F.lit(1), starts)))

    def covered(hash_list: Column) -> Column:
        by_hash = F.sort_array(F.transform(hash_list, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(by_hash, lambda s: let(F.array_sort(repeated(s)), length))

    def repeated(s: Column) -> Column:
        """Start of each window with an equal neighbour in hash order."""
        same = F.filter(
            s, lambda x, k: x["h"].eqNullSafe(F.get(s, k - 1)["h"]) | x["h"].eqNullSafe(F.get(s, k + 1)["h"])
        )
        return F.transform(same, lambda x: x["i"])

    def length(starts: Column) -> Column:
        steps = F.zip_with(starts, F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0))),
                           lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    return F.when(n < WINDOW, F.lit(0)).otherwise(
        let(hashes(), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
    )


def measures(text: Column) -> Column:
    """Struct of counts (long): n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    text = F.coalesce(text, F.lit(""))

    def count(word_list: Column) -> Column:
        n = F.size(word_list)
        lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
        line_counts = let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct")))
        return let(line_counts, lambda line: F.struct(
            n.cast("long").alias("n_words"),
            F.length(F.array_join(word_list, "")).cast("long").alias("word_chars"),
            (F.size(F.split(text, SYMBOLS, -1)) - 1).cast("long").alias("n_symbols"),
            line["n"].cast("long").alias("n_lines"),
            (line["n"] - line["distinct"]).cast("long").alias("n_dup_lines"),
            _repeat_words(word_list).cast("long").alias("n_repeat_words"),
        ))

    return let(words(text), count)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


@dataclass(frozen=True)
class Rule:
    """A document fails where its value lies beyond the middle half of its group by more than FENCE times that
    half's width, or by more than ``slack`` where that is larger. ``low`` says whether small values fail too."""

    name: str
    value: Column
    slack: int
    low: bool = False


#: Fence width in interquartile ranges, and the least number of documents whose quantiles stand for themselves.
FENCE = 3
MIN_GROUP = 200


def rules(m: Column) -> list[Rule]:
    """Shares in thousandths; the mean word length in hundredths of a character."""

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, F.floor(1000 * part / whole)).otherwise(F.lit(0)).cast("long")

    mean_length = F.when(m["n_words"] > 0, F.floor(100 * m["word_chars"] / m["n_words"])).otherwise(F.lit(0)).cast("long")
    return [
        Rule("word_length", mean_length, 200, low=True),
        Rule("symbols", share(m["n_symbols"], m["word_chars"]), 50),
        Rule("dup_lines", share(m["n_dup_lines"], m["n_lines"]), 400),
        Rule("repeat_words", share(m["n_repeat_words"], m["n_words"]), 300),
    ]


def sketch_bucket(value: Column) -> Column:
    """Lower end of the value's bucket: exact below 128, then 64 buckets for each doubling (1.6 % wide)."""
    shift = F.greatest(F.length(F.bin(value)) - 7, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(values: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """(keys, rule, bucket, n): quantile sketches of the columns ``names``; they merge by adding up ``n``."""
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("rule"), sketch_bucket(F.col(c)).alias("bucket")) for i, c in enumerate(names)]))
    return values.select(*keys, each.alias("x")).groupBy(*keys, F.col("x.rule").alias("rule"), F.col("x.bucket").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")
    )


def quartiles(sketch: DataFrame, keys: list[str], n_rules: int) -> DataFrame:
    """(keys, n_docs, q): q[i] is a struct (q1, q3) of rule i, from sketches merged to ``keys``."""
    merged = sketch.groupBy(*keys, "rule", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "rule")
    ranked = merged.withColumn("seen", F.sum("n").over(group.orderBy("bucket"))).withColumn("total", F.sum("n").over(group))
    by_rule = ranked.groupBy(*keys, "rule").agg(
        F.max("total").alias("total"),
        F.min(F.when(4 * F.col("seen") >= F.col("total"), F.col("bucket"))).alias("q1"),
        F.min(F.when(4 * F.col("seen") >= 3 * F.col("total"), F.col("bucket"))).alias("q3"),
    )
    each = [F.max(F.when(F.col("rule") == i, F.struct("q1", "q3"))) for i in range(n_rules)]
    return by_rule.groupBy(*keys).agg(F.max("total").alias("n_docs"), F.array(*each).alias("q"))


def thresholds(sketch: DataFrame, lang: str, source: str, n_rules: int) -> DataFrame:
    """(lang, source, q): quartiles of the pair; of its language, or of all, where there are fewer than MIN_GROUP."""
    pair = quartiles(sketch, [lang, source], n_rules)
    by_lang = quartiles(sketch, [lang], n_rules).select(F.col(lang).alias("__lang"), F.col("n_docs").alias("__n"), F.col("q").alias("__q"))
    every = quartiles(sketch, [], n_rules).first()["q"]  # one row
    every = F.array(*[F.struct(F.lit(q and q.q1).cast("long").alias("q1"), F.lit(q and q.q3).cast("long").alias("q3")) for q in every])
    joined = pair.join(by_lang, pair[lang].eqNullSafe(F.col("__lang")))
    q = F.when(F.col("n_docs") >= MIN_GROUP, F.col("q")).when(F.col("__n") >= MIN_GROUP, F.col("__q")).otherwise(every)
    return joined.select(F.col(lang).alias("t_lang"), F.col(source).alias("t_source"), q.alias("q"))


def judge(
    docs: DataFrame, lang: str = "lang", source: str = "source", text_col: str = "text", carried: list[str] | None = None
) -> DataFrame:
    """(doc, m, base_failed, kept): ``doc`` has the row's columns (or those of ``carried``), ``m`` its measures.

    A null text has no words and fails; null languages and sources form groups of their own. Equal rows are
    judged alike, an empty table gives no rows.
    """
    doc = F.struct(*[F.col(f"`{c}`") for c in carried or docs.columns])
    measured = docs.select(doc.alias("doc"), measures(F.col(text_col)).alias("m"))
    measured = durable(measured.select("doc", "m", base_failed(F.col("m")).alias("base_failed")))
    checks = rules(F.col("m"))
    names = [r.name for r in checks]
    valued = measured.where(~F.col("base_failed")).select(
        F.col("doc")[lang].alias("lang"), F.col("doc")[source].alias("source"), *[r.value.alias(r.name) for r in checks]
    )
    limits = durable(thresholds(durable(sketches(valued, ["lang", "source"], names)), "lang", "source", len(checks)))
    passed = ~F.col("base_failed")
    for i, rule in enumerate(checks):
        q1, q3 = F.col("q")[i]["q1"], F.col("q")[i]["q3"]
        margin = F.greatest(FENCE * (q3 - q1), F.lit(rule.slack))
        passed &= rule.value <= q3 + margin
        if rule.low:
            passed &= rule.value >= q1 - margin
    same_group = F.col("doc")[lang].eqNullSafe(F.col("t_lang")) & F.col("doc")[source].eqNullSafe(F.col("t_source"))
    return measured.join(limits, same_group, "left").select("doc", "m", "base_failed", F.coalesce(passed, F.lit(False)).alias("kept"))


def quality_report(docs: DataFrame, id_col: str = "doc_id", lang: str = "lang", source: str = "source", text_col: str = "text") -> DataFrame:
    """(id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) of every row."""
    judged = judge(docs, lang, source, text_col, [*dict.fromkeys([id_col, lang, source])])
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(F.col("doc")[id_col].alias(id_col), *[F.col("m")[c].alias(c) for c in counts], "base_failed", "kept")


def keep_good(docs: DataFrame, lang: str = "lang", source: str = "source", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that judge() keeps."""
    return judge(docs, lang, source, text_col).where("kept").select("doc.*")
