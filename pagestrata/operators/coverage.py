"""How well topics cover the questions of past exams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import squeeze
from .joins import keyword_matches, missing


def matches(topics: DataFrame, keywords: DataFrame, top: int = 5) -> DataFrame:
    """The best topics of each question (exam, session, q_num), ties in topic order."""
    words = keywords.select("exam", "session", "q_num", F.explode("terms").alias("term")).withColumn("term", squeeze("term", upper=True))
    t = topics.select("topic_id", squeeze("q_title", upper=True).alias("t"), squeeze(F.concat_ws(" ", "intent", "approach", "content"), upper=True).alias("c"))
    found = keyword_matches(t, words, "topic_id", "t", "c", ["exam", "session", "q_num"], "term")
    w = Window.partitionBy("exam", "session", "q_num").orderBy(F.desc("score"), "topic_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def hit_table(keywords: DataFrame, found: DataFrame) -> DataFrame:
    """Per exam direct, indirect and missed questions, and the percentage; questions without terms are skipped."""
    best = found.groupBy("exam", "session", "q_num").agg(F.bool_or(F.col("match") == "direct").alias("direct"))
    q = keywords.join(best, ["exam", "session", "q_num"], "left").withColumn("scorable", F.size("terms") > 0)
    direct, some = F.count_if(F.col("scorable") & F.col("direct")), F.count_if(F.col("scorable") & F.col("direct").isNotNull())
    n = F.count_if("scorable")
    return q.groupBy("exam").agg(n.alias("scorable"), direct.alias("direct"), (some - direct).alias("indirect"), (n - some).alias("missed"), F.count_if(~F.col("scorable")).alias("skipped"), F.floor(100 * some / F.greatest(n, F.lit(1))).alias("percent"))


def gaps(keywords: DataFrame, found: DataFrame) -> DataFrame:
    """Questions that no topic covers."""
    return missing(keywords.where(F.size("terms") > 0), found, ["exam", "session", "q_num"])


def subject_matrix(topics: DataFrame, generations: list[str] | None = None) -> DataFrame:
    """A12."""
    g = topics.groupBy("subject")
    return (g.pivot("gen", generations) if generations else g.pivot("gen")).count().na.fill(0)


def subject_totals(topics: DataFrame) -> DataFrame:
    """Counts by subject and cohort with subtotals; level is 0 for a count, 1 for a subject's, 3 for all."""
    return topics.rollup("subject", "gen").agg(F.count("*").alias("n"), F.grouping_id().cast("long").alias("level"))


def generation_stats(topics: DataFrame) -> DataFrame:
    """A13, A18."""
    filled = lambda c: F.count_if(F.trim(F.coalesce(c, F.lit(""))) != "")
    return topics.groupBy("gen").agg(F.count("*").alias("topics"), F.count_distinct("week").alias("weeks"), F.count_distinct("session").alias("sessions"), *[filled(c).alias(f"with_{c}") for c in ("intent", "approach", "content")])


def unexamined(topics: DataFrame, mark: str = "미출제") -> DataFrame:
    """A14; the intent is cut to 100 characters first."""
    return topics.where(F.col("intent").contains(mark)).select("topic_id", "gen", "q_title", F.substring("intent", 1, 100).alias("intent"))


def exam_references(topics: DataFrame, low: int = 80, high: int = 140) -> DataFrame:
    """Exam numbers that intents name, with their topics."""
    refs = topics.select("topic_id", F.explode(F.array_distinct(F.regexp_extract_all("intent", F.lit(r"(\d{2,3})\s*회"), F.lit(1)))).alias("n")).withColumn("number", F.col("n").cast("int"))
    return refs.where(F.col("number").between(low, high)).groupBy("number").agg(F.count("*").alias("n_topics"), F.sort_array(F.collect_list("topic_id")).alias("topic_ids"))


def first_titles(questions: DataFrame, order: Column | str) -> DataFrame:
    """The first title of each question."""
    return questions.groupBy("exam", "session", "q_num").agg(F.min_by("q_title", order).alias("q_title"))


def report(hits: DataFrame, missing_: DataFrame, stats: DataFrame) -> str:
    """A Markdown report of every exam, every question not covered and every cohort."""
    out = ["# Coverage", "", "| exam | scorable | direct | indirect | missed | percent |", "|-|-|-|-|-|-|"]
    out += [f"| {r.exam} | {r.scorable} | {r.direct} | {r.indirect} | {r.missed} | {r.percent} |" for r in hits.orderBy("exam").collect()]
    out += ["", "## Not covered", ""] + [f"- {r.exam} {r.session}-{r.q_num} {r.label}" for r in missing_.orderBy("exam", "session", "q_num").collect()]
    out += ["", "## Cohorts", ""] + [f"- {r.gen}: {r.topics} topics, {r.weeks} weeks" for r in stats.orderBy("gen").collect()]
    return "\n".join(out) + "\n"
