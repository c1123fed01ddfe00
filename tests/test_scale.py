"""Queries on small tables made for what larger tables hold."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from pagestrata.functions import catalog as C
from pagestrata.functions import text as T
from pagestrata.operators import formats, postprocess, signal_engine, titles
from pagestrata.plans.format_queries import page_elements
from pagestrata.sources.stages import staged

duckdb = pytest.importorskip("duckdb")

from pagestrata.plans import registry  # noqa: E402


#: A text for each pattern of catalog.NEEDS whose pieces alone are no match.
MATCHES = [
    "I. 로마 절의 제목", "문제 3. 카드의 제목", "문 제", "2교시 3번", "제 2 교시", "FB12", "기술사 시험문제", "기술사 제 137 회 제 2 교시", "출제 빈도", "[참고]", "감사의 글", "기출 풀이집", "기출풀이 의견", "★★☆", "설명하시오", "이다.", "3일차", "IT trends 클라우드 | PM",
    "KPC 기술사", "관리 3 교시", "관리 - 2 교시", "실전 모의고사 문제", "뒷 페이지에 계속", "앞페이지에서 계속", "100 분", "문제를 선택하여", "선택 문제", "다음 문제 중", "시험시간 : 100분", "3 번", "제 3. 자료를 나누는", "누구나 ICT", "cafe.naver", "All rights", "SW  DB CA", "IT trends", "Big & Up", "AI/Bigdata",
    "“끝”", "도메인", "출제영역 하나", "[ 관리 선택 ]", "수험", "page", "ICT의 가치를 이끄는", "정보처리기술사 기출풀이", "Copyright 아이리포",
]


def documents(spark, folder, texts, source="a"):
    """A folder with the table documents, one row a text, ids from 0."""
    rows = [(k, t, "en", source, len(t or "")) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def as_its_sql(spark, name, folder):
    """The query's rows, once they are those of its SQL."""
    con = duckdb.connect()
    con.sql(f"create view documents as select * from read_parquet('{folder}/documents.parquet/*.parquet')")
    want = con.sql(registry.ORACLES[name])
    got = registry.QUERIES[name](spark, folder)
    assert sorted(got.columns) == sorted(want.columns)
    rows = [tuple(r) for r in got.select(*want.columns).collect()]
    plain = lambda rs: sorted(repr(tuple(round(float(v), 6) if isinstance(v, float) else v for v in r)) for r in rs)
    assert plain(rows) == plain(want.fetchall())
    return rows


def test_even_spacing_with_any_start(spark, tmp_path):
    """Short tokens count alone: a line joins even if it starts like a section."""
    folder = documents(spark, tmp_path, ["Anti. Of Of Of Of Of", "IV. a b c", "a. b c\nlonger words stay apart", None])
    rows = dict(as_its_sql(spark, "collapse_even_spacing", folder))
    assert rows["Anti. Of Of Of Of Of"] == "Anti.OfOfOfOfOf" and rows["IV. a b c"] == "IV.abc"


def test_pieces_are_needed(spark):
    """Looking for its pieces first never changes what a pattern finds."""
    rng = random.Random(5)
    said = sorted({piece for pieces in C.NEEDS.values() for piece in pieces} | set(MATCHES))
    junk = ["", " ", "\n", " ", "\t", "1", "2.", "제 3", "I. abcd", "가. abcde", "x", "100 ", "문 ", ":"]
    spread = lambda t: "".join(x + rng.choice(["", "", " ", " "]) for x in t)
    texts = said + [spread(t) for t in said] + ["".join(rng.choice(junk + said) for _ in range(rng.randint(1, 6))) for _ in range(1500)] + MATCHES * 2
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    c = F.col("c")
    plain = lambda p: c.rlike(T.U + p)
    bare = F.regexp_replace(c, r"(?U)\s+", "")
    flat = [C.KPC_PROBLEM, C.KPC_OPINION, C.KPC_HEADER, C.ITPE_META, C.ITPE_LABEL, C.INFOLEVER, C.AIRIPO_MOCK, C.AIRIPO_MORE, C.FORMAT_COVER, C.KPC_NOISE, C.AIRIPO_SESSION, C.KPC_BRAND, C.AIRIPO_BRAND, C.AIRIPO_CONTINUED, C.AIRIPO_LABEL]
    brands = [C.KPC_BRAND, C.AIRIPO_BRAND]
    pairs = [(T.has(c, p), plain(p)) for p in C.NEEDS if p not in brands] + [(T.flat_has(c, p), bare.rlike(T.U + p)) for p in flat]
    pairs += [(T.flat_group(c, C.AIRIPO_SESSION), F.nullif(F.regexp_extract(bare, T.U + C.AIRIPO_SESSION, 1), F.lit("")))]
    pairs += [(T.group(c, p), F.nullif(F.regexp_extract(c, T.U + p, 1), F.lit(""))) for p in (C.MENTI, C.SESSION, C.DAY, C.COVER_CAPTION, C.HEADER_KW)]
    pairs += [(T.strip(c), F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))]
    row = df.agg(*[F.count_if(~a.eqNullSafe(b)).alias(f"d{k}") for k, (a, b) in enumerate(pairs)], *[F.count_if(F.coalesce(b.cast("string"), F.lit("false")) != "false").alias(f"n{k}") for k, (_, b) in enumerate(pairs)]).first()
    assert [k for k in range(len(pairs)) if row[f"d{k}"]] == []
    assert [k for k in range(len(pairs)) if not row[f"n{k}"]] == []  # every pattern is found somewhere
    blanks = "".join(chr(i) for i in range(0x10000) if not 0xD800 <= i < 0xE000)
    left = spark.createDataFrame([(blanks,)], "c string").select(F.array_join(F.regexp_extract_all("c", F.lit(r"(?U)(\s)"), F.lit(1)), "")).first()[0]
    assert sorted(left) == sorted(T.BLANKS)


@pytest.mark.parametrize("name", ["format_kpc", "page_signs"])
def test_elements_are_made_once(spark, tmp_path, name):
    """The result's steps start from written elements; none makes them from the documents anew."""
    rng = random.Random(7)
    folder = documents(spark, tmp_path, ["x" * rng.randint(30, 60) + "\nsome more lines of this page here" for _ in range(40)])
    assert "documents.parquet" not in registry.QUERIES[name](spark, folder)._jdf.queryExecution().toString()


def test_pages_of_lines_are_cut_once(spark, tmp_path):
    """As elements, for the line engine; and of a page only the lines that are looked at are written."""
    folder = documents(spark, tmp_path, ["own line\n" * 30 for _ in range(40)])
    as_its_sql(spark, "line_topics", folder)
    assert "documents.parquet" not in registry.QUERIES["line_topics"](spark, folder)._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def engine(spark, tmp_path_factory):
    """Written tables of a few documents: e (marked elements), p (pages' flags), blocks, pages (their formats' marks), shown (their titles)."""
    folder = documents(spark, tmp_path_factory.mktemp("engine"), ["x" * (k % 12 + 30) for k in range(40)])
    e = titles.marked(page_elements(spark, folder, {}))
    p = staged(signal_engine.page_flags(e))
    return {"e": e, "p": p, "blocks": staged(signal_engine.sessions(p)), "pages": staged(formats.format_pages(e)), "shown": staged(titles.page_titles(e))}


def assert_nothing_sent(df):
    """However small the tables are here, no side of a join goes whole to the driver."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_sessions_and_airipo_send_no_table_to_the_driver(engine):
    assert_nothing_sent(signal_engine.sessions(engine["p"]))
    assert_nothing_sent(formats.airipo(engine["pages"], engine["shown"]))


def test_pages_of_blocks_are_not_sent_to_the_driver(engine):
    """Nor are blocks exploded to their pages, which Spark takes to be as few as the blocks."""
    first = F.min(F.when(F.col("end"), F.col("page")))
    assert_nothing_sent(formats.fronts(engine["pages"], engine["blocks"], first))
    assert_nothing_sent(formats.kpc(engine["pages"], engine["blocks"], engine["shown"]))


def test_flags_of_pages_are_not_sent_to_the_driver(engine):
    p, blocks = engine["p"], engine["blocks"]
    assert_nothing_sent(signal_engine.in_blocks(p, blocks))
    assert_nothing_sent(signal_engine.weights(p))
    chosen = blocks.select("doc_id", "session", "expected", F.lit("t").alias("title"), "page_start", "page_end", F.lit(0.5).alias("confidence"))
    assert_nothing_sent(signal_engine.sub_splits(chosen, p))
    listed = chosen.drop("expected").withColumns({"fmt": F.lit("topic"), "num": F.lit(1)})
    assert_nothing_sent(postprocess.merge_short(listed, blocks))
