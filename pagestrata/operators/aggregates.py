"""Counts, weights, ladders and quality figures over a document's elements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ladder(counts: DataFrame, rules: Sequence[tuple[Column, str]], otherwise: str, name: str = "format") -> DataFrame:
    """A1: the label of the first rule that holds."""
    out = None
    for cond, label in rules:
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return counts.withColumn(name, out.otherwise(otherwise))


def calibrate(counts: DataFrame, caps: dict[str, float], gate: int = 3) -> DataFrame:
    """A2: per signal 0 below the gate, else min(n / cap, 1); all divided by the largest (0.01 at least)."""
    raw = {s: F.when(F.col(s) >= gate, F.least(F.col(s) / F.lit(float(k)), F.lit(1.0))).otherwise(0.0) for s, k in caps.items()}
    top = F.greatest(*raw.values(), F.lit(0.01))
    return counts.select(*[c for c in counts.columns if c not in caps], *[(v / top).alias(f"w_{s}") for s, v in raw.items()])


def dominant(weights: DataFrame, signals: Sequence[str]) -> DataFrame:
    """The signal with the largest weight; the first of equals."""
    ranked = F.array_sort(F.array(*[F.struct((-F.col(f"w_{s}")).alias("w"), F.lit(i).alias("i"), F.lit(s).alias("s")) for i, s in enumerate(signals)]))
    return weights.withColumn("dominant", F.get(ranked, F.lit(0))["s"])


def repeated_headers(lines: DataFrame, part: Sequence[str], page: str, text: str, wanted: Column, share: float = 0.15, least: int = 3) -> DataFrame:
    """A3: texts with max(least, share * pages) occurrences or more; occurrences of elements count, not pages."""
    n_pages = lines.groupBy(*part).agg(F.max(page).alias("n_pages"))
    counted = lines.where(wanted).groupBy(*part, text).agg(F.count("*").alias("n"))
    return counted.join(n_pages, list(part)).where(F.col("n") >= F.greatest(F.lit(float(least)), share * F.col("n_pages"))).drop("n_pages")


def repeated_lines(lines: DataFrame, part: Sequence[str], page: str, text: str, key: Column, high: float = 0.8, low: float = 0.4, least: int = 3, mean_chars: float = 10, exempt: Column | None = None) -> DataFrame:
    """A4: variants of a normalised line on many distinct pages, or on fewer if its distinct variants are long in the mean."""
    n_pages = lines.groupBy(*part).agg(F.count_distinct(page).alias("n_pages"))
    keyed = lines.withColumn("key", key).where("key != ''")
    keyed = keyed if exempt is None else keyed.where(~exempt)
    variants = keyed.groupBy(*part, "key", text).agg(F.collect_set(page).alias("_p"))
    grouped = variants.groupBy(*part, "key").agg(F.size(F.array_distinct(F.flatten(F.collect_list("_p")))).alias("n"), F.avg(F.length(text)).alias("mean"), F.collect_list(text).alias("_v"))
    held = grouped.join(n_pages, list(part)).where((F.col("n") >= F.greatest(F.lit(least), F.floor(high * F.col("n_pages")))) | ((F.col("n") >= F.greatest(F.lit(least), F.floor(low * F.col("n_pages")))) & (F.col("mean") >= mean_chars)))
    return held.select(*part, "key", F.col("n").cast("long").alias("n"), F.explode("_v").alias("variant"))


def font_ratio(df: DataFrame, part: Sequence[str], size: str, name: str = "font_ratio") -> DataFrame:
    """Size by the document's median size; 1.0 where there is none."""
    medians = df.where(F.col(size) > 0).groupBy(*part).agg(F.expr(f"percentile({size}, 0.5)").alias("_m"))
    return df.join(medians, list(part), "left").withColumn(name, F.coalesce(F.col(size) / F.col("_m"), F.lit(1.0))).drop("_m")


#: The lowest score of each grade but the last.
GRADES = ((0.95, "우수"), (0.80, "양호"), (0.60, "보통"))


def quality(df: DataFrame, found: str, expected: str, warnings: str, grades: Sequence[tuple[float, str]] = GRADES, lowest: str = "낮음") -> DataFrame:
    """Share of the expected count (1 at most; 0.5 where nothing is expected), less 0.02 a warning, 0.1 at least."""
    met = F.when(F.col(expected) == 0, 0.5).otherwise(F.least(F.col(found) / F.nullif(F.col(expected), F.lit(0)), F.lit(1.0)))
    out = df.withColumn("score", F.round(F.greatest(met - 0.02 * F.col(warnings), F.lit(0.1)), 4))
    grade = None
    for least, name in grades:
        grade = F.when(F.col("score") >= least, name) if grade is None else grade.when(F.col("score") >= least, name)
    return out.withColumn("grade", grade.otherwise(lowest))


def coverage(intervals: DataFrame, part: Sequence[str], start: str, end: str, pages: DataFrame, n_pages: str) -> DataFrame:
    """Distinct pages that intervals cover, and their share."""
    covered = intervals.select(*part, F.explode(F.sequence(start, end)).alias("_p")).distinct().groupBy(*part).agg(F.count("*").alias("covered"))
    joined = pages.join(covered, list(part), "left").withColumn("covered", F.coalesce("covered", F.lit(0)).cast("long"))
    return joined.withColumn("share", F.round(F.col("covered") / F.greatest(F.col(n_pages), F.lit(1)), 6))


def number_gaps(df: DataFrame, part: Sequence[str], number: str) -> DataFrame:
    """Numbers from 1 to the largest that are missing."""
    seen = df.groupBy(*part).agg(F.collect_set(F.col(number).cast("int")).alias("_s"), F.max(F.col(number).cast("int")).alias("_m"))
    gone = seen.withColumn("missing", F.array_except(F.sequence(F.lit(1), "_m"), "_s")).where(F.size("missing") > 0)
    return gone.select(*part, F.array_join(F.transform(F.array_sort("missing"), lambda x: x.cast("string")), ",").alias("missing"))


def accuracy(rows: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Per group and in all, totals and how often either engine's count is the expected one."""
    a, b = F.col("a_count") == F.col("expected"), F.col("b_count") == F.col("expected")
    return rows.rollup(*groups).agg(F.count("*").alias("total"), F.count_if(a).alias("a_match"), F.count_if(b).alias("b_match"), F.count_if(a & b).alias("both"), F.count_if(a & ~b).alias("only_a"), F.count_if(b & ~a).alias("only_b"))


def session_ranges(marks: DataFrame, part: Sequence[str], page: str, order: str, number: str) -> DataFrame:
    """A10: each session from its first page to the page before the next session's, or to its last one. Of several marks on a page the last one counts. marks: part, page, order, number."""
    from pyspark.sql import Window

    per_page = marks.groupBy(*part, page).agg(F.max_by(number, order).alias(number))
    spans = per_page.groupBy(*part, number).agg(F.min(page).alias("page_start"), F.max(page).alias("_last"))
    nxt = F.lead("page_start").over(Window.partitionBy(*part).orderBy(number))
    expected = F.when(F.col(number) == 1, 13).otherwise(6)
    return spans.withColumn("page_end", F.greatest("_last", F.coalesce(nxt - 1, F.col("_last")))).withColumn("expected", expected).drop("_last")


def unsigned_noise(lines: DataFrame, part: Sequence[str], page: str, noise: Column, signal: Column) -> DataFrame:
    """Pages with noise and without a topic's sign, in one aggregate."""
    return lines.groupBy(*part, page).agg(F.bool_or(noise).alias("_n"), F.bool_or(signal).alias("_s")).where("_n and not _s").select(*part, page)


def mean_by(rows: DataFrame, keys: Sequence[str], *values: str) -> DataFrame:
    """Counts and mean values of each key, rounded to six places."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), *[F.round(F.avg(v), 6).alias(f"mean_{v}") for v in values])


#: Words that tell a topic's text, signs that badly read pages are full of, the letters of the profile's script.
TOPIC_WORDS = ("출제의도", "작성방안", "Keyword", "출제빈도", "개요", "상세설명")
READ_NOISE = r"[□■●○◎△▲※★☆◆◇]"
SCRIPT = r"[\x{AC00}-\x{D7A3}]"


def extraction_quality(text: Column, script: str = SCRIPT, words: Sequence[str] = TOPIC_WORDS, noise: str = READ_NOISE) -> dict[str, Column]:
    """How well a text was extracted: whether it has rows of a table and headings, letters of the script and their share, the words found, in their order, and signs of noise. A null text is empty."""
    c = F.coalesce(text, F.lit(""))
    letters = F.regexp_count(c, F.lit(script)).cast("long")
    return {
        "has_table": c.rlike(r"(?d)\|.*\|"),
        "has_heading": c.rlike(r"(?mdU)^#{1,3}\s"),
        "n_letters": letters,
        "letter_share": F.round(letters / F.greatest(F.length(c), F.lit(1)), 3),
        "words": F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(c, w)),
        "n_noise": F.regexp_count(c, F.lit(noise)).cast("long"),
    }


def most_frequent(rows: DataFrame, key: str, most: int = 5) -> DataFrame:
    """The `most` keys with the most rows, ties by key."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(most)


def length_class(session: Column, pages: Column) -> Column:
    """How unusual a topic's length is: bad, warn or empty. Short answers have one to three pages, essays three to six."""
    essay = session.between(2, 4)
    return (
        F.when((session == 1) & (pages > 4), "bad")
        .when((session == 1) & (pages > 3), "warn")
        .when(essay & ((pages > 8) | (pages.between(1, 1))), "bad")
        .when(essay & ((pages > 6) | (pages == 2)), "warn")
        .otherwise("")
    )
