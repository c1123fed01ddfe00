"""Functions on titles, lines and names over the documents' own lines and words, with what the length of each puts around it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.tables import table, text_lines
from .registry import query
from .text_queries import LINES

BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
#: SQL: the distinct lines with a number, a roman numeral or a question's label in front, or none.
TITLES = f"""{LINES}, x_ AS (SELECT DISTINCT line, CASE length(line) % 5 WHEN 0 THEN ' 3) ' || line WHEN 1 THEN 'IV. ' || line WHEN 2 THEN '12. II. 문 제 7. ' || line WHEN 3 THEN '문제 4 ' || line ELSE line || ' ' END AS x FROM lines_)"""


def numbered(spark, sf_dir):
    r, line = F.length("line") % 5, F.col("line")
    x = F.when(r == 0, F.concat(F.lit(" 3) "), line)).when(r == 1, F.concat(F.lit("IV. "), line)).when(r == 2, F.concat(F.lit("12. II. 문 제 7. "), line)).when(r == 3, F.concat(F.lit("문제 4 "), line)).otherwise(F.concat(line, F.lit(" ")))
    return text_lines(spark, sf_dir).select("line").distinct().select("line", x.alias("x"))


@query(rf"""WITH {TITLES}, b_ AS (SELECT line, x, regexp_replace(regexp_replace(regexp_replace(trim(x, {BLANKS}), '^[0-9]{{1,2}}\s*[.)]\s*', ''), '^[IVX]+\.\s*', ''), '^문\s*제?\s*[0-9]{{1,2}}\s*[.)]?\s*', '') AS bare FROM x_)
SELECT line, trim(x, {BLANKS}) AS plain, bare, lower(regexp_replace(regexp_replace(bare, '\([^)]*\)', '', 'g'), '[\s\-_·,./:]+', '', 'g')) AS key FROM b_""")
def title_parts(spark, sf_dir):
    """Blanks, labels in front, keys of titles."""
    return numbered(spark, sf_dir).select("line", T.norm("x").alias("plain"), T.strip_title_prefix("x").alias("bare"), T.title_key("x").alias("key"))


#: SQL: the distinct words with a particle behind.
PARTICLES = f"""{LINES}, w_ AS (SELECT DISTINCT unnest(string_split(line, ' ')) AS word FROM lines_), p_ AS (SELECT word, word || [{", ".join(f"'{p}'" for p in T.PARTICLES)}][length(word) % {len(T.PARTICLES)} + 1] AS x FROM w_)"""


@query(f"""WITH {PARTICLES}, s_ AS (SELECT word, x, regexp_extract(x, '^(.{{2,}}?)(?:{"|".join(T.PARTICLES)})$', 1) AS stem FROM p_)
SELECT word, x, CASE WHEN length(stem) >= 2 THEN stem ELSE x END AS stem FROM s_""")
def particles(spark, sf_dir):
    """one particle off the end."""
    words = text_lines(spark, sf_dir).select(F.explode(F.split("line", " ", -1)).alias("word")).distinct()
    x = F.concat("word", F.get(F.array(*[F.lit(p) for p in T.PARTICLES]), F.length("word") % len(T.PARTICLES)))
    return words.select("word", x.alias("x"), T.drop_particle(x).alias("stem"))


#: SQL: the distinct lines with an acronym, an English term in parentheses and a Korean word; in plain, letters outside ASCII are signs that belong to words.
TERMS = f"""{LINES}, x_ AS (SELECT DISTINCT line, 'Data' || length(line) || ' and ' || line || ' API-' || length(line) || ' (Edge ' || length(line) || ') 클라우드를 AI' AS x FROM lines_),
a_x_ AS (SELECT line, x, regexp_replace(x, '[À-ɏ가-힣]', '_', 'g') AS plain FROM x_)"""


@query(rf"""WITH {TERMS}, f_ AS (SELECT line, list_concat(list_concat(regexp_extract_all(plain, '\b([A-Z][A-Z0-9&/-]{{1,}})\b', 1), regexp_extract_all(x, '\(([A-Za-z][A-Za-z0-9 &/-]+)\)', 1)), [regexp_extract(x, '^([^(),.:]+)', 1)]) AS found FROM a_x_),
a_ AS (SELECT line, list_distinct(list_filter(list_transform(found, lambda s: trim(s)), lambda s: length(s) >= 4)) AS a FROM f_), u_ AS (SELECT line, unnest(a) AS s FROM a_)
SELECT line, string_agg(s, '|' ORDER BY length(s) DESC, encode(s)) AS anchors FROM u_ GROUP BY line""")
def title_anchors(spark, sf_dir):
    """acronyms, English in parentheses, the first noun phrase."""
    return with_terms(spark, sf_dir).select("line", F.array_join(T.anchors("x"), "|").alias("anchors"))


@query(rf"""WITH {TERMS}, f_ AS (SELECT line, list_distinct(list_concat(list_transform(regexp_extract_all(x, '[가-힣]{{2,}}'), lambda s: regexp_replace(s, '를$', '')), regexp_extract_all(plain, '\b([A-Z][A-Za-z0-9]+)\b', 1))) AS k FROM a_x_)
SELECT line, array_to_string(list_sort(list_filter(k, lambda s: s NOT IN ('AI', 'The'))), '|') AS words FROM f_""")
def title_words(spark, sf_dir):
    """Korean words without particle and capitalised ones, less generic ones."""
    return with_terms(spark, sf_dir).select("line", F.array_join(F.array_sort(T.keywords("x", ("AI", "The"))), "|").alias("words"))


def with_terms(spark, sf_dir):
    n = F.length("line").cast("string")
    x = F.concat(F.lit("Data"), n, F.lit(" and "), "line", F.lit(" API-"), n, F.lit(" (Edge "), n, F.lit(") 클라우드를 AI"))
    return text_lines(spark, sf_dir).select("line").distinct().select("line", x.alias("x"))


@query(rf"""WITH {LINES}, d_ AS (SELECT DISTINCT line FROM lines_), c_ AS (SELECT line, regexp_replace(regexp_replace(nfc_normalize(line), '[\\/:*?"<>|]', '_', 'g'), '\s+', ' ', 'g') AS s FROM d_)
SELECT line, nfc_normalize(line) AS composed, rtrim(substring(s, 1, 60)) AS file, replace(replace(replace(replace(replace(line, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#39;') AS html FROM c_""")
def safe_texts(spark, sf_dir):
    """composed letters, file names, HTML."""
    lines = text_lines(spark, sf_dir).select("line").distinct()
    return lines.select("line", T.nfc("line").alias("composed"), T.safe_filename("line").alias("file"), T.escaped("line").alias("html"))


#: SQL: file names made of each page's id and address.
NAMES = r"""n_ AS (SELECT page_id, '/data/' || CASE page_id % 4 WHEN 0 THEN '모의_KPC' WHEN 1 THEN '합숙_itpe' WHEN 2 THEN '모의 - 동기회 ' ELSE '아이리포' END || CAST(page_id AS VARCHAR) || CASE page_id % 3 WHEN 0 THEN '관_DS' WHEN 1 THEN '응 AI_NW 2교시' ELSE '_XAI DB보안' END || CASE page_id % 5 WHEN 0 THEN '_합' WHEN 1 THEN '-합' ELSE '' END || CASE page_id % 7 WHEN 0 THEN '.PDF' ELSE '.pdf' END AS x FROM pages)"""


@query(rf"""WITH {NAMES}, s_ AS (SELECT page_id, x, regexp_replace(regexp_replace(x, '^.*/', ''), '(?i)\.pdf$', '') AS s FROM n_)
SELECT page_id, replace(regexp_replace(regexp_replace(regexp_replace(s, '^모의[_\s-]+', ''), '[_\s-]?합$', ''), '\s+', '-', 'g'), '_', '-') AS general,
  replace(regexp_replace(regexp_replace(s, '^모의_', ''), '[-_]?합$', ''), '_', '-') AS kpc, regexp_replace(regexp_replace(s, '^모의_', ''), '[-_]?합$', '') AS itpe,
  CASE WHEN regexp_matches(x, '(?i)KPC') THEN 'KPC' WHEN regexp_matches(x, '(?i)ITPE') THEN 'ITPE' WHEN contains(x, '동기회') THEN '동기회' WHEN contains(x, '아이리포') THEN '아이리포' ELSE 'UNKNOWN' END AS source,
  CASE WHEN contains(x, '관') THEN '관' WHEN contains(x, '응') THEN '응' ELSE '?' END AS exam,
  CASE WHEN page_id % 2 = 0 THEN regexp_replace(replace(regexp_replace(x, '^.*/', ''), '.pdf', ''), '^모의_', '') ELSE regexp_replace(replace(regexp_replace(x, '^.*/', ''), '.pdf', ''), '^합숙_', '') END AS material,
  CASE WHEN regexp_extract(x, '([0-9])\s*교시', 1) = '' THEN '0교시' ELSE regexp_extract(x, '([0-9])\s*교시', 1) || '교시' END AS session,
  coalesce(nullif(array_to_string(list_filter(['DS', 'AI', 'NW'], lambda c: regexp_matches(upper(x), '(^|[^A-Z])' || c || '([^A-Z0-9]|$)')), '+'), ''), CASE WHEN contains(x, '보안') THEN 'SEC' ELSE 'ETC' END) AS codes FROM s_""")
def name_parts(spark, sf_dir):
    """Rounds, sources, exams, materials, sessions and subjects from file names."""
    k = lambda n, *values: F.get(F.array(*[F.lit(v) for v in values]), (F.col("page_id") % n).cast("int"))
    x = F.concat(F.lit("/data/"), k(4, "모의_KPC", "합숙_itpe", "모의 - 동기회 ", "아이리포"), F.col("page_id").cast("string"), k(3, "관_DS", "응 AI_NW 2교시", "_XAI DB보안"), k(5, "_합", "-합", "", "", ""), k(7, ".PDF", *[".pdf"] * 6))
    names = table(spark, sf_dir, "pages").select("page_id", x.alias("x"))
    kind = F.when(F.col("page_id") % 2 == 0, "모의고사").otherwise("합숙")
    rounds = {f: T.round_id("x", f).alias(f) for f in ("general", "kpc", "itpe")}
    return names.select("page_id", *rounds.values(), T.file_source("x").alias("source"), T.file_exam("x").alias("exam"), T.material_name("x", kind).alias("material"), T.session_label("x").alias("session"), T.subject_codes("x", ("DS", "AI", "NW"), words={"보안": "SEC"}).alias("codes"))


#: What a page of an answer says, by label: of each event's properties.
@query("""SELECT event_id, trim(props) AS intent, 'how ' || event_type AS approach, '[' || props || ', ' || props || ']' AS listed, CAST(2 AS BIGINT) AS n_objects, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def labelled_answers(spark, sf_dir):
    """texts behind their labels, the array of a fenced answer, objects of lines with bare keys."""
    props = F.col("props")
    page = F.concat(F.lit("출제 의도 : "), props, F.lit("\n접근방안: how "), "event_type", F.lit("\n\nI. 개요"))
    fenced = F.concat(F.lit("```json\n["), props, F.lit(", "), props, F.lit("]\n```"))
    bare = F.concat(F.lit("text\n"), F.regexp_replace(props, r'"([A-Za-z_]+)"\s*:', "$1:"), F.lit("\n{broken\n"), props)
    objects = T.json_lines(bare, "k int")
    return table(spark, sf_dir, "events").select("event_id", T.intent(page).alias("intent"), T.approach(page).alias("approach"), T.unfence(fenced).alias("listed"), F.size(objects).cast("long").alias("n_objects"), F.get(objects, F.lit(0))["k"].alias("k"))
