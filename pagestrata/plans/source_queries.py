"""Sources and sinks over the tables: Markdown topics, pages read twice, the keyed table, jobs that end."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates
from ..sources import elements, markdown
from ..sources.keyed import KeyedTable
from ..sources.stages import stage_path
from ..sources.tables import table, text_pages
from ..streaming import job_store
from .registry import query
from .text_queries import PAGES

#: SQL: the documents with some of their lines made headings, cards or rows of tables, by the length of the line.
MARKDOWN = """l_ AS (SELECT doc_id, i, ls[i] AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
k_ AS (SELECT doc_id, i, line, length(line) % 24 AS r, CAST(length(line) % 37 AS VARCHAR) AS num FROM l_),
md_ AS (SELECT doc_id, string_agg(CASE r WHEN 0 THEN '## ' || num || '. ' || line WHEN 1 THEN '카드 문 제 ' || num || '. ' || line WHEN 2 THEN '|' || num || '|' || replace(line, '|', '/') || '|x|' WHEN 3 THEN '|' || num || '| ab |x|' WHEN 4 THEN '##### ' || num || '. ' || line ELSE line END, chr(10) ORDER BY i) AS md FROM k_ GROUP BY doc_id)"""


def marked_down(spark, sf_dir):
    num = lambda x: (F.length(x) % 37).cast("string")

    def line(x):
        r = F.length(x) % 24
        return (
            F.when(r == 0, F.concat(F.lit("## "), num(x), F.lit(". "), x))
            .when(r == 1, F.concat(F.lit("카드 문 제 "), num(x), F.lit(". "), x))
            .when(r == 2, F.concat(F.lit("|"), num(x), F.lit("|"), F.replace(x, F.lit("|"), F.lit("/")), F.lit("|x|")))
            .when(r == 3, F.concat(F.lit("|"), num(x), F.lit("| ab |x|")))
            .when(r == 4, F.concat(F.lit("##### "), num(x), F.lit(". "), x))
            .otherwise(x)
        )

    lines = F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), line)
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(lines, "\n").alias("md"))


@query(rf"""WITH {MARKDOWN},
h_ AS (SELECT doc_id, 0 AS turn, 'heading' AS method, unnest(regexp_extract_all(md, '(?m)^#{{1,4}}\s+(\d{{1,2}})\.\s+(.+)', 1)) AS num, unnest(regexp_extract_all(md, '(?m)^#{{1,4}}\s+(\d{{1,2}})\.\s+(.+)', 2)) AS title, unnest(range(len(regexp_extract_all(md, '(?m)^#{{1,4}}\s+(\d{{1,2}})\.\s+(.+)')))) AS place FROM md_),
c_ AS (SELECT doc_id, 1, 'menti_card', unnest(regexp_extract_all(md, '문\s*제\s+(\d{{1,2}})\.\s+(.+)', 1)), unnest(regexp_extract_all(md, '문\s*제\s+(\d{{1,2}})\.\s+(.+)', 2)), unnest(range(len(regexp_extract_all(md, '문\s*제\s+(\d{{1,2}})\.\s+(.+)')))) FROM md_),
t_ AS (SELECT doc_id, 2, 'table_cell', unnest(regexp_extract_all(md, '(?m)^\|(\d{{1,2}})\|([^|]+)\|', 1)), unnest(regexp_extract_all(md, '(?m)^\|(\d{{1,2}})\|([^|]+)\|', 2)), unnest(range(len(regexp_extract_all(md, '(?m)^\|(\d{{1,2}})\|([^|]+)\|')))) FROM md_),
a_ AS (SELECT doc_id, turn, method, CAST(num AS INTEGER) AS num, trim(title, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS title, place FROM (SELECT * FROM h_ UNION ALL SELECT * FROM c_ UNION ALL SELECT * FROM t_)),
o_ AS (SELECT *, row_number() OVER (PARTITION BY doc_id, num ORDER BY turn, place) AS k FROM a_ WHERE turn < 2 OR length(title) > 3)
SELECT doc_id, num, title, method FROM o_ WHERE k = 1""")
def markdown_topics(spark, sf_dir):
    """Headings, cards and table rows of the documents' lines; the first of a number counts."""
    return markdown.markdown_topics(marked_down(spark, sf_dir), "doc_id", "md")


@query(f"""WITH {PAGES}, s_ AS (SELECT doc, pg, trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS own, CASE WHEN pg % 3 = 0 THEN NULL WHEN pg % 3 = 1 THEN '' ELSE replace(text, ' ', '_') END AS read FROM pages_),
p_ AS (SELECT doc, pg, CASE WHEN length(own) > 50 THEN own || chr(10) || chr(10) WHEN length(read) > 0 THEN '[OCR p' || pg || ']' || chr(10) || read || chr(10) || chr(10) END AS part FROM s_)
SELECT doc AS doc_id, sha256(coalesce(string_agg(part, '' ORDER BY pg), '')) AS content_sha256 FROM p_ GROUP BY doc""")
def text_or_image(spark, sf_dir):
    """Pages of fifty characters or fewer come from a second source, which here reads blanks as marks and leaves some pages out."""
    pages = text_pages(spark, sf_dir).select(F.col("doc").alias("doc_id"), F.col("pg").cast("int").alias("page"), "text")
    second = pages.where("page % 3 <> 0").select("doc_id", "page", F.when(F.col("page") % 3 == 1, "").otherwise(F.replace("text", F.lit(" "), F.lit("_"))).alias("text"))
    return markdown.text_or_image(pages, second).select("doc_id", F.sha2("content", 256).alias("content_sha256"))


@query("""WITH l_ AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events)
SELECT user_id, event_id, event_type, value FROM l_ WHERE k = 1 AND event_type <> 'error'""")
def keyed_table(spark, sf_dir):
    """Events as changes of their user's row, by two writers whose batches interleave with a compaction; the last change counts, an error deletes."""
    changes = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value", (F.col("event_type") == "error").alias("deleted"))
    keyed = KeyedTable(spark, stage_path(spark), changes.drop("deleted").schema, ["user_id"], ["ts", "event_id"])
    part = lambda k: changes.where(F.pmod("event_id", F.lit(4)) == k)
    keyed.write(part(3), "one-2")
    keyed.write(part(0), "two-1")
    keyed.compact()
    keyed.write(part(1), "one-1")
    keyed.write(part(2), "two-2")
    keyed.write(part(0), "two-1")  # run again
    return keyed.read().select("user_id", "event_id", "event_type", "value")


@query("""WITH l_ AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events), now_ AS (SELECT max(ts) AS now FROM events)
SELECT user_id, event_type FROM l_, now_ WHERE k = 1 AND NOT (event_type IN ('purchase', 'error') AND ts <= now - INTERVAL 30 MINUTE)""")
def live_jobs(spark, sf_dir):
    """Users as jobs: purchases and errors end them, and thirty minutes later they are gone."""
    events = table(spark, sf_dir, "events")
    now = events.agg(F.max("ts").alias("now")).first()["now"]
    return job_store.live_jobs(events, F.lit(now), 30, ("purchase", "error"), "user_id", "event_type", "ts", ("event_id",)).select("user_id", "event_type")


@query("""SELECT doc_id, regexp_matches(t, '[|].*[|]') AS has_table, regexp_matches(t, '(?m)^#{1,3}[ ]') AS has_heading, CAST(len(regexp_extract_all(t, '[A-Z]')) AS BIGINT) AS n_letters,
  round(len(regexp_extract_all(t, '[A-Z]')) / greatest(length(t), 1), 3) AS letter_share, array_to_string(list_filter(['License', 'the', '@', 'x'], lambda w: contains(t, w)), ',') AS words, CAST(len(regexp_extract_all(t, '[#$%&*]')) AS BIGINT) AS n_noise
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)""")
def extraction_quality(spark, sf_dir):
    """A28 with capitals as the script."""
    told = aggregates.extraction_quality(F.col("text"), "[A-Z]", ("License", "the", "@", "x"), "[#$%&*]")
    return table(spark, sf_dir, "documents").select("doc_id", *[(F.array_join(v, ",") if k == "words" else v).alias(k) for k, v in told.items()])


#: SQL: what a parser finds on each web page, in order: headings with font size 20, paragraphs with 10, lists with 12, of which each item is a line.
BLOCKS = """h_ AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
x_ AS (SELECT page_id, 1 AS turn, 'heading' AS kind, 20 AS size, unnest(regexp_extract_all(html, '<h1>([^<]*)</h1>', 1)) AS t FROM h_
  UNION ALL SELECT page_id, 2, 'paragraph', 10, unnest(regexp_extract_all(html, '<p>([^<]*)</p>', 1)) FROM h_
  UNION ALL SELECT page_id, 3, 'item', 12, unnest(regexp_extract_all(html, '<li>([^<]*)</li>', 1)) FROM h_),
s_ AS (SELECT *, trim(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS c FROM x_)"""


@query(f"""WITH {BLOCKS},
f_ AS (SELECT page_id, quantile_cont(size, 0.5) AS m FROM (SELECT page_id, size FROM s_ WHERE kind = 'heading' OR (kind = 'paragraph' AND length(c) > 1) OR (kind = 'item' AND length(c) > 2)) GROUP BY page_id)
SELECT CAST(page_id AS VARCHAR) AS doc_id, CASE kind WHEN 'heading' THEN 'heading' ELSE 'paragraph' END AS type, count(*) AS n, CAST(sum(length(c)) AS BIGINT) AS n_chars, CAST(round(max(size / m), 6) AS DOUBLE) AS largest
FROM s_ JOIN f_ USING (page_id) WHERE kind = 'heading' OR (kind = 'paragraph' AND length(c) > 1) OR (kind = 'item' AND length(c) > 2) GROUP BY page_id, CASE kind WHEN 'heading' THEN 'heading' ELSE 'paragraph' END""")
def parser_elements(spark, sf_dir):
    """Web pages as a parser's answers, and these as elements with font ratios: headings, paragraphs of over one character, items of over two."""
    html = F.coalesce("html", F.lit(""))
    found = lambda tag: F.regexp_extract_all(html, F.lit(f"<{tag}>([^<]*)</{tag}>"), F.lit(1))
    block = lambda kind, text, size: F.struct(F.lit(kind).alias("type"), text.alias("text"), F.lit(1).alias("pageNumber"), F.struct(F.lit(size).alias("fontSize")).alias("style"))
    blocks = F.concat(F.transform(found("h1"), lambda t: block("heading", t, 20.0)), F.transform(found("p"), lambda t: block("paragraph", t, 10.0)), F.transform(found("li"), lambda t: block("list", F.concat(F.lit("• "), t), 12.0)))
    answer = F.concat(F.lit("parser's log line\n"), F.to_json(F.struct(F.lit(True).alias("success"), F.lit(1).alias("totalPages"), blocks.alias("blocks"))))
    raw = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("doc_id"), answer.alias("value"))
    of = elements.elements(elements.parsed(raw))
    return of.groupBy("doc_id", "type").agg(F.count("*").alias("n"), F.sum(F.length("content")).cast("long").alias("n_chars"), F.round(F.max("font_ratio"), 6).alias("largest"))


#: SQL: files named after the pages' ids, in several folders, of several kinds and endings.
FILES = """n_ AS (SELECT page_id, ['/r/18기/3주차', '/r/bak/특강', '/r/x_split'][page_id % 3 + 1] AS folder,
  ['리뷰_SW_', '리뷰_경영_', '리뷰_x_', 'KPC 관-', 'ITPE_응_', '리뷰 복사본 DB '][page_id % 6 + 1] || page_id || ['.pdf', '-1.pdf', ' 2교시.pdf', '-답.pdf', '.txt'][page_id % 5 + 1] AS name FROM pages),
files_ AS (SELECT page_id, folder || '/' || name AS path, name, page_id * 400000 AS length, CASE WHEN page_id % 7 = 0 THEN 'text' ELSE '%PDF-1.7' END AS content, page_id % 8 * 90 AS n_pages FROM n_)"""


def page_files(spark, sf_dir):
    page = F.col("page_id")
    pick = lambda *values: F.get(F.array(*[F.lit(v) for v in values]), (page % len(values)).cast("int"))
    name = F.concat(pick("리뷰_SW_", "리뷰_경영_", "리뷰_x_", "KPC 관-", "ITPE_응_", "리뷰 복사본 DB "), page.cast("string"), pick(".pdf", "-1.pdf", " 2교시.pdf", "-답.pdf", ".txt"))
    path = F.concat(pick("/r/18기/3주차", "/r/bak/특강", "/r/x_split"), F.lit("/"), name)
    content = F.encode(F.when(page % 7 == 0, "text").otherwise("%PDF-1.7"), "utf-8")
    return table(spark, sf_dir, "pages").select("page_id", path.alias("path"), name.alias("name"), (page * 400000).alias("length"), content.alias("content"), (page % 8 * 90).alias("n_pages"))


@query(f"""WITH {FILES} SELECT path, regexp_extract(path, '([0-9]{{1,3}}기)', 1) AS gen, CASE WHEN contains(path, '주차') THEN '3주차' WHEN contains(path, '특강') THEN '특강' ELSE 'UNKNOWN' END AS week,
  CASE WHEN contains(name, '2교시') THEN '2교시' ELSE '0교시' END AS session, CASE WHEN contains(name, '_SW_') THEN 'SW' WHEN contains(name, '경영') THEN '경영' WHEN contains(path, '특강') THEN '특강' ELSE 'ETC' END AS subject
FROM files_ WHERE contains(name, '리뷰') AND NOT contains(name, '복사본')""")
def review_files(spark, sf_dir):
    """Review files with cohort, week, session and subject."""
    return elements.reviews(page_files(spark, sf_dir)).select("path", "gen", "week", "session", "subject")


@query(rf"""WITH {FILES}, c_ AS (SELECT page_id FROM files_ WHERE NOT regexp_matches(name, '작성답안|총평|멘토링|초고|교시\.pdf| 답\.pdf|-답[1-4]|-답\.pdf') AND NOT regexp_matches(name, '(?i)-\s*[1-4](?:~[0-9])?\.pdf$|_\s*[1-4]교시') AND NOT regexp_matches(path, '(bak|_split).*/'))
SELECT path, page_id IN (SELECT page_id FROM c_) AS in_corpus, CASE WHEN NOT ends_with(lower(name), '.pdf') THEN 'extension' WHEN length > 52428800 THEN 'size' WHEN content NOT LIKE '!%PDF-%' ESCAPE '!' THEN 'magic' WHEN n_pages NOT BETWEEN 1 AND 500 THEN 'pages' END AS refused FROM files_""")
def file_admission(spark, sf_dir):
    """Files that are split, and the first rule that an upload breaks."""
    files = page_files(spark, sf_dir)
    corpus = elements.corpus_files(files).select("path", F.lit(True).alias("in_corpus"))
    return elements.valid_uploads(files).join(corpus, "path", "left").select("path", F.coalesce("in_corpus", F.lit(False)).alias("in_corpus"), "refused")
