"""Engines in turn: each sees the documents that all before it refused.

An engine is a function from documents (doc_id) to its intervals and its
verdict on each document. Intervals and verdicts are written before the next
engine starts, so that one only reads the documents that are still open.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import catalog as C
from ..functions.text import U, has
from ..sources.stages import staged
from . import joins, line_engine, mock_papers, order, papers, signal_engine

INTERVALS = ["doc_id", "session", "num", "title", "page_start", "page_end", "confidence"]
Engine = Callable[[DataFrame], tuple[DataFrame, DataFrame]]


def cascade(docs: DataFrame, engines: Sequence[tuple[str, Engine]]) -> tuple[DataFrame, DataFrame]:
    """The intervals of the first engine that takes a document, with its name as engine; and each verdict (doc_id, step, engine, ok, reason). A document without a verdict of an engine is refused by it."""
    left = staged(docs.select("doc_id").distinct())
    taken, told = [], []
    for step, (name, run) in enumerate(engines, 1):
        found, verdict = run(left)
        known = staged(left.join(verdict.select("doc_id", "ok", "reason"), "doc_id", "left").select("doc_id", F.coalesce("ok", F.lit(False)).alias("ok"), F.coalesce("reason", F.lit("nothing found")).alias("reason")))
        yes = known.where("ok").select("doc_id")
        taken.append(staged(found.select(*INTERVALS).join(yes, "doc_id", "left_semi").withColumn("engine", F.lit(name))))
        told.append(known.select("doc_id", F.lit(step).alias("step"), F.lit(name).alias("engine"), "ok", "reason"))
        left = staged(left.join(yes, "doc_id", "left_anti"))
    return reduce(DataFrame.unionByName, taken), reduce(DataFrame.unionByName, told)


# ---------------------------------------------------------------- what a document is


def heads(pages: DataFrame, most: int = C.HEAD_PAGES) -> DataFrame:
    """doc_id, head: the lines of a document's first `most` pages."""
    first = pages.where(F.col("page") <= most).select("doc_id", "page", F.concat(F.array_join("lines", "\n"), F.lit("\n")).alias("_t"))
    return first.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "_t"))), lambda r: r["_t"]), "").alias("head"))


def first_label(c: Column, rules: Sequence[tuple[str, str]]) -> Column:
    return F.coalesce(*[F.when(has(c, pattern), F.lit(label)) for label, pattern in rules])


def publisher(head: Column, name: Column) -> Column:
    """By the head, else by the file's name."""
    return F.coalesce(first_label(head, C.PUBLISHERS), first_label(name, C.NAMED), F.lit("unknown"))


def exam_kind(head: Column, name: Column) -> Column:
    """Actual, mock or unknown; words for past exams come before those for mock ones, in the name the other way round."""
    return F.coalesce(first_label(head, (("actual", C.ACTUAL), ("mock", C.MOCK))), first_label(name, (("mock", "모의"), ("actual", "기출"))), F.lit("unknown"))


def classified(pages: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """doc_id, publisher, kind, itpe_mock, kpc_mock: the last two tell whether the parser of that publisher's mock papers may have the document, by its head or else its name, never one with words for past exams. names: doc_id, name."""
    docs = pages.select("doc_id").distinct().join(heads(pages), "doc_id", "left")
    docs = docs.join(names.select("doc_id", "name"), "doc_id", "left") if names is not None else docs.withColumn("name", F.lit(None).cast("string"))
    head, name = F.coalesce("head", F.lit("")), F.coalesce("name", F.lit(""))
    mock = lambda brand, own: ~has(head, C.ACTUAL) & (has(head, brand) | has(name, f"(?i){own}"))
    return docs.select("doc_id", publisher(head, name).alias("publisher"), exam_kind(head, name).alias("kind"), mock(C.ITPE_MOCK, "itpe").alias("itpe_mock"), mock(C.KPC_MOCK, "kpc").alias("kpc_mock"))


# ---------------------------------------------------------------- engines


def _as_intervals(found: DataFrame, number: str = "num", title: str = "title", confidence: Column | None = None) -> DataFrame:
    ints = [F.col(c).cast("int").alias(n) for c, n in (("session", "session"), (number, "num"))]
    return found.select("doc_id", *ints, F.col(title).alias("title"), *[F.col(c).cast("int").alias(c) for c in ("page_start", "page_end")], (confidence if confidence is not None else F.lit(1.0)).alias("confidence"))


def _if_any(found: DataFrame, docs: DataFrame, admitted: DataFrame) -> DataFrame:
    """Documents with intervals are taken; the others were not admitted or hold no question."""
    some = found.select("doc_id").distinct().withColumn("ok", F.lit(True))
    tried = docs.join(admitted.select("doc_id", F.lit(True).alias("_in")), "doc_id", "left").join(some, "doc_id", "left")
    return tried.select("doc_id", F.coalesce("ok", F.lit(False)).alias("ok"), F.when(F.col("_in").isNull(), "not admitted").when(F.col("ok").isNull(), "no questions").otherwise("").alias("reason"))


def kpc_questions(pages: DataFrame) -> DataFrame:
    """doc_id, session, number, topic, page_start, page_end of mock papers whose sessions have no cover: a session starts where the number falls; a paper or an empty page ends a question."""
    kinds = order.reset_sessions(papers.classify_kpc(pages.select("doc_id", "page", papers.kpc_body(F.col("lines")).alias("body"))), ["doc_id"], ["page"], "number")
    last = pages.groupBy("doc_id").agg(F.max("page").alias("last"))
    closed = order.close_at_blocker(kinds.join(last, "doc_id"), ["doc_id"], "page", F.col("kind") == "Q_START", F.col("kind").isin("EMPTY_PAGE", "SESSION_PAPER"), F.col("last"))
    return closed.select("doc_id", "session", "number", "topic", "page_start", F.greatest("page_end", "page_start").alias("page_end"))


def mock_engine(pages: DataFrame, kinds: DataFrame, flag: str, questions: Callable[[DataFrame], DataFrame]) -> Engine:
    def run(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
        admitted = staged(kinds.where(F.col(flag)).join(docs, "doc_id", "left_semi").select("doc_id"))
        found = staged(_as_intervals(questions(pages.join(admitted, "doc_id", "left_semi")), "number", "topic"))
        return found, _if_any(found, docs, admitted)

    return run


def verified(topics: DataFrame, docs: DataFrame, expected: DataFrame, said: DataFrame, slack: int = 2, least: int = 5) -> DataFrame:
    """doc_id, ok, reason of line topics.

    Where the publisher and kind are known (expected: doc_id, session,
    expected), every session's count has to be within `slack` of the expected one;
    a session without topics is one that the document leaves out, unless it is
    said there (said: doc_id, session). Else `least` topics are enough.
    """
    n = topics.groupBy("doc_id", "session").agg(F.count("*").alias("n"))
    each = expected.join(n, ["doc_id", "session"], "left").join(said.select("doc_id", "session", F.lit(True).alias("_said")), ["doc_id", "session"], "left")
    off = F.when(F.col("n").isNull(), F.col("_said").isNotNull()).otherwise(F.abs(F.col("n") - F.col("expected")) > slack)
    wrong = F.when(off, F.concat(F.col("session").cast("string"), F.lit(":"), F.coalesce("n", F.lit(0)).cast("string"), F.lit("/"), F.col("expected").cast("string")))
    per = each.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list(wrong)), " ").alias("_wrong"))
    all_ = docs.join(topics.groupBy("doc_id").agg(F.count("*").alias("topics")), "doc_id", "left").join(per, "doc_id", "left")
    reason = (
        F.when(F.col("topics").isNull(), "no candidates")
        .when(F.col("_wrong").isNull() & (F.col("topics") < least), F.concat(F.lit("few topics "), F.col("topics").cast("string")))
        .when(F.coalesce("_wrong", F.lit("")) != "", F.concat(F.lit("counts "), F.col("_wrong")))
        .otherwise("")
    )
    return all_.select("doc_id", reason.alias("reason")).withColumn("ok", F.col("reason") == "")


def line_verified(pages: DataFrame, kinds: DataFrame) -> Engine:
    """The line engine with its check against the exam's counts."""

    def run(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
        own = pages.join(docs, "doc_id", "left_semi")
        topics = staged(line_engine.topics(own))
        table = docs.sparkSession.createDataFrame(C.EXPECTED, "publisher string, kind string, session int, expected int")
        expected = kinds.join(docs, "doc_id", "left_semi").join(joins.checked_broadcast(table), ["publisher", "kind"]).select("doc_id", "session", "expected")
        marks = F.regexp_extract_all(F.array_join("lines", "\n"), F.lit(U + C.SESSION_SAID), F.lit(1))
        said = own.select("doc_id", F.explode(F.array_distinct(marks).cast("array<int>")).alias("session")).distinct()
        return _as_intervals(topics), verified(topics, docs, expected, said)

    return run


def element_engine(elements: DataFrame) -> Engine:
    """By the publisher's format, else by weighted signals: takes whatever has a topic."""

    def run(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
        found = signal_engine.detect(elements.join(docs, "doc_id", "left_semi")).where("fmt <> 'question_pages'")
        numbered = staged(_as_intervals(order.page_axis(found, ["doc_id"], ["page_start", "page_end"], "num"), confidence=F.col("confidence")))
        return numbered, _if_any(numbered, docs, docs)

    return run


def engines(pages: DataFrame, elements: DataFrame, names: DataFrame | None = None) -> list[tuple[str, Engine]]:
    """The parsers of two publishers' mock papers, the line engine with its check, and the element engine. pages: doc_id, page, lines."""
    kinds = staged(classified(pages, names))
    return [
        ("itpe_mock", mock_engine(pages, kinds, "itpe_mock", lambda p: mock_papers.line_questions(p.select("doc_id", "page", papers.itpe_body(F.col("lines")).alias("body"))))),
        ("kpc_mock", mock_engine(pages, kinds, "kpc_mock", kpc_questions)),
        ("lines", line_verified(pages, kinds)),
        ("elements", element_engine(elements)),
    ]


def segmented(pages: DataFrame, elements: DataFrame, names: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Every document's intervals by the first engine that takes it, and what each engine said."""
    return cascade(pages.select("doc_id"), engines(pages, elements, names))
