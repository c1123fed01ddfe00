"""Files and parser output as tables, and reports as files."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import file_exam, file_source, material_name, round_id, session_label, strip, subject_codes
from ..operators.aggregates import font_ratio

PARSED = (
    "success boolean, error string, isImageBased boolean, totalPages int, metadata struct<pageCount:int>,"
    " blocks array<struct<type:string,text:string,pageNumber:int,level:int,style:struct<fontSize:double>,table:struct<rows:int,cols:int,cells:array<array<struct<text:string>>>>>>"
)


def find_files(spark: SparkSession, root: str, glob: str = "*.pdf", content: bool = False) -> DataFrame:
    """Path, name, length, modificationTime (and content) of files below root."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    return df.withColumn("name", F.element_at(F.split("path", "/"), -1)).select("path", "name", "length", "modificationTime", *(["content"] if content else []))


#: Names of a week's folder, subjects and what they are called else, marks of files that are parts or answers.
WEEK_WORDS = ("주차", "오리엔테이션", "멘티출제", "특강", "합반", "자체모의", "서바이벌")
SUBJECTS = ("SW", "DS", "DB", "SE", "AI", "CAOS", "NW", "경영", "AL", "OT")
SUBJECT_WORDS = {"보안": "SE", "멘티출제": "전범위", "자체모의": "전범위", "합반": "전범위", "특강": "특강", "서바이벌": "특강"}
PART_NAMES = r"작성답안|총평|멘토링|초고|교시\.pdf| 답\.pdf|-답[1-4]|-답\.pdf"
SINGLE_SESSION = r"(?i)-\s*[1-4](?:~\d)?\.pdf$|_\s*[1-4]교시"
LEFT_OUT = r"아이리포|라이지움|회사|bak"


def reviews(files: DataFrame, generations: tuple[str, ...] = (), old: bool = True, word: str = "리뷰", copy: str = "복사본") -> DataFrame:
    """Review files by name, with cohort (the folder of that name, or the number before 기), week (the last folder named as one), subject and session; without `old` those of bak folders go."""
    kept = files.where(F.col("name").contains(word) & ~F.col("name").contains(copy))
    if not old:
        kept = kept.where(~F.col("path").contains("/bak/"))
    folders = F.slice(F.split("path", "/"), F.lit(1), F.size(F.split("path", "/")) - 1)
    week = F.try_element_at(F.filter(folders, lambda x: x.rlike("|".join(WEEK_WORDS))), F.lit(-1))
    gen = F.try_element_at(F.filter(folders, lambda x: x.isin(*generations)), F.lit(1)) if generations else F.nullif(F.regexp_extract("path", r"(\d{1,3}기)", 1), F.lit(""))
    named = kept.select("path", "name", F.coalesce(gen, F.lit("")).alias("gen"), F.coalesce(week, F.lit("UNKNOWN")).alias("week"), session_label("name").alias("session"))
    subject = subject_codes(F.concat_ws(" ", "week", "name"), SUBJECTS, words=SUBJECT_WORDS, plain=("경영",))
    return named.withColumn("subject", subject).orderBy("gen", "week", "session", "path")


def exam_files(main: DataFrame, old: DataFrame) -> DataFrame:
    """Files of past exams of known publishers with source, exam and session; a file of the main folder replaces the old one of its name."""
    both = last_of_name(old, main).where(F.col("name").rlike(r"(?i)\.pdf$"))
    session = F.coalesce(F.nullif(F.regexp_extract("name", r"(\d)교시", 1), F.lit("")), F.when(~F.col("name").contains("합"), F.nullif(F.regexp_extract("name", r"(?i)-(\d)\.pdf$", 1), F.lit("")))).cast("int")
    out = both.select("path", "name", file_source("name").alias("source"), file_exam("name").alias("exam"), session.alias("session"))
    return out.where(~F.col("source").isin("UNKNOWN", "아이리포")).orderBy("source", "exam", F.coalesce("session", F.lit(0)), "path")


def material_files(files: DataFrame, root: str, kind: str) -> DataFrame:
    """S3: files right in the publishers' folders below root, without old ones and those of other schools: folder, name, source name."""
    tail = F.split(F.regexp_replace("path", "^.*?" + re.escape(root.rstrip("/")) + "/", ""), "/")
    kept = files.withColumn("t", tail).where((F.size("t") == 2) & F.lower(F.get("t", F.lit(0))).isin("itpe", "kpc") & ~F.get("t", F.lit(0)).rlike(LEFT_OUT) & ~F.lower("name").contains("bak") & F.lower("name").endswith(".pdf"))
    return kept.select("path", F.get("t", F.lit(0)).alias("folder"), "name", material_name("name", F.lit(kind)).alias("source_name")).orderBy("folder", "name")


def corpus_files(files: DataFrame) -> DataFrame:
    """Files to be split: no parts, answers or single sessions, none below bak or already split folders."""
    folder = F.regexp_replace("path", "/[^/]*$", "")
    return files.where(~F.col("name").rlike(PART_NAMES) & ~F.col("name").rlike(SINGLE_SESSION) & ~folder.rlike("bak|_split"))


def last_of_name(*sources: DataFrame) -> DataFrame:
    """Of files with one name (in any case) the one from the last source."""
    both = None
    for k, df in enumerate(sources):
        one = df.withColumn("_p", F.lit(k))
        both = one if both is None else both.unionByName(one)
    w = Window.partitionBy(F.lower("name")).orderBy(F.desc("_p"), "path")
    return both.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_p", "_r")


def valid_uploads(files: DataFrame, most: int = 50 << 20, pages: int = 500) -> DataFrame:
    """With the first rule a file breaks, or null. files has content and, once they are counted, n_pages."""
    reason = F.when(~F.lower("name").endswith(".pdf"), "extension").when(F.col("length") > most, "size").when(F.substring("content", 1, 5) != F.encode(F.lit("%PDF-"), "utf-8"), "magic")
    if "n_pages" in files.columns:
        reason = reason.when(~F.col("n_pages").between(1, pages), "pages")
    return files.withColumn("refused", reason)


def parsed(raw: DataFrame, doc: str = "doc_id", json: str = "value") -> DataFrame:
    """Parser answers: doc_id and the answer from the first brace on, as a struct."""
    return raw.select(F.col(doc).alias("doc_id"), F.from_json(F.regexp_extract(json, r"(?s)(\{.*)", 1), PARSED).alias("r"))


def elements(answers: DataFrame) -> DataFrame:
    """Tables one row a cell (over two characters) and a marker, lists one a line, headings all, paragraphs over one character; with font ratios."""
    b = answers.select("doc_id", F.posexplode("r.blocks").alias("block", "b")).select("doc_id", "block", "b.*", F.col("b.style.fontSize").alias("font_size"))
    make = lambda kind, text, level=F.lit(None).cast("int"), cell=F.lit(False), rows=F.lit(None).cast("int"), cols=F.lit(None).cast("int"): F.struct(
        F.lit(kind).alias("type"), text.alias("content"), level.alias("heading_level"), cell.alias("is_table_cell"), rows.alias("table_rows"), cols.alias("table_cols")
    )
    cells = F.transform(F.filter(F.transform(F.flatten("table.cells"), lambda c: strip(F.coalesce(c["text"], F.lit("")))), lambda t: F.length(t) > 2), lambda t: make("paragraph", t, cell=F.lit(True)))
    marker = F.array(make("table_marker", F.lit(""), rows=F.col("table.rows"), cols=F.col("table.cols")))
    lines = F.transform(F.filter(F.transform(F.split("text", "\n"), lambda t: F.regexp_replace(strip(t), r"^[-•·*]\s*", "")), lambda t: F.length(t) > 2), lambda t: make("paragraph", t))
    text = strip(F.coalesce("text", F.lit("")))
    one = (
        F.when(F.col("type") == "table", F.concat(F.coalesce(cells, F.array()), marker))
        .when(F.col("type") == "list", lines)
        .when(F.col("type") == "heading", F.array(make("heading", text, F.col("level"))))
        .when(F.length(text) > 1, F.array(make("paragraph", text)))
    )
    rows = b.select("doc_id", F.col("pageNumber").alias("page"), "block", "font_size", F.posexplode(one).alias("part", "e")).select("doc_id", "page", "block", "part", "font_size", "e.*")
    w = Window.partitionBy("doc_id").orderBy("page", "block", "part")
    numbered = rows.withColumn("elem_idx", F.row_number().over(w)).drop("block", "part").withColumn("source", F.lit(None).cast("string"))
    return font_ratio(numbered, ["doc_id"], "font_size")


def page_blocks(answers: DataFrame) -> DataFrame:
    """Blocks by page; a table without text is its cells, joined."""
    b = answers.select("doc_id", F.posexplode("r.blocks").alias("idx", "b"))
    cells = F.array_join(F.transform(F.flatten("b.table.cells"), lambda c: F.coalesce(c["text"], F.lit(""))), " | ")
    text = F.when((F.col("b.type") == "table") & (F.coalesce("b.text", F.lit("")) == ""), cells).otherwise(F.col("b.text"))
    return b.select("doc_id", F.col("b.pageNumber").alias("page"), "idx", F.col("b.type").alias("type"), text.alias("text"), F.col("b.style.fontSize").alias("font_size"), F.col("b.level").alias("heading_level"), (F.col("b.type") == "table").alias("is_table"))


def ocr_lines(pages: DataFrame, reader, partitions: int | None = None) -> DataFrame:
    """Elements from page images. reader(bytes) gives lines and runs on the executors; pages: doc_id, page, image."""

    def run(it):
        import pandas as pd

        for pdf in it:
            rows = [(d, p, k, "paragraph", line, "ocr") for d, p, img in zip(pdf["doc_id"], pdf["page"], pdf["image"]) for k, line in enumerate(reader(img)) if len(line) > 2]
            yield pd.DataFrame(rows, columns=["doc_id", "page", "elem_idx", "type", "content", "source"])

    dealt = pages.repartition(partitions, "doc_id", "page") if partitions else pages.repartition("doc_id", "page")
    return dealt.mapInPandas(run, "doc_id string, page int, elem_idx int, type string, content string, source string")


def content_key(content: Column | str, version: str, no_header_footer: bool | None = None) -> Column:
    """The key of a parse: parser version, for page blocks whether heads and feet were left out, and content."""
    flag = [] if no_header_footer is None else [F.lit(f"nhf{int(no_header_footer)}")]
    return F.concat_ws(":", F.lit(version), *flag, F.sha2(content, 256))


def copies(rows: DataFrame, id_col: str, content: Column) -> DataFrame:
    """One row for each content: its key, smallest id and count."""
    return rows.select(F.col(id_col), F.sha2(content, 256).alias("content_key")).groupBy("content_key").agg(F.min(id_col).alias(id_col), F.count("*").alias("n_copies"))


def to_parse(files: DataFrame, cache: DataFrame, version: str) -> DataFrame:
    """Files whose content and parser version the cache doesn't hold. files has content."""
    keyed = files.withColumn("content_key", content_key("content", version))
    good = cache.where(F.col("n_elements") > 0).select("content_key")
    return keyed.join(good, "content_key", "left_anti")


def manifest(intervals: DataFrame, pages: DataFrame, prefix: Column | str = "doc_id") -> DataFrame:
    """One row an interval: filename (repeats numbered), pages, and pages with under 50 characters. pages: doc_id, page, n_chars."""
    thin = pages.where("n_chars < 50").select("doc_id", "page")
    pages_of = intervals.withColumn("page", F.explode(F.sequence("page_start", "page_end")))
    counted = pages_of.join(thin.withColumn("_t", F.lit(1)), ["doc_id", "page"], "left").groupBy("doc_id", "session", "num", "title", "page_start", "page_end").agg(F.count("_t").alias("image_pages"))
    head = F.col(prefix) if isinstance(prefix, str) else prefix
    name = F.concat_ws("_", round_id(head), F.col("session").cast("string"), F.lpad(F.col("num").cast("string"), 2, "0"), F.regexp_replace(F.substring("title", 1, 60), r'[\\/:*?"<>|]', "_"))
    w = Window.partitionBy("doc_id", "_f").orderBy("page_start")
    numbered = counted.withColumn("_f", name).withColumn("_k", F.row_number().over(w))
    return numbered.select("doc_id", F.concat("_f", F.when(F.col("_k") > 1, F.concat(F.lit("_"), F.col("_k").cast("string"))).otherwise(""), F.lit(".pdf")).alias("filename"), "session", "num", "title", "page_start", "page_end", (F.col("page_end") - F.col("page_start") + 1).alias("pages"), "image_pages")


def write_report(df: DataFrame, path: str, form: str = "json") -> None:
    """JSON lines, CSV with a header, or Parquet."""
    df.write.mode("overwrite").format(form).options(**({"header": True} if form == "csv" else {})).save(path)


def write_topics(topics: DataFrame, inventory: DataFrame, out: str) -> None:
    """Topics with their texts and the inventory of files, as JSON lines below out."""
    write_report(topics, f"{out}/topics")
    write_report(inventory, f"{out}/inventory")


def latest_rows(changes: DataFrame, key: str, ts: str, deleted: str | None = None) -> DataFrame:
    """Of each key the row of its last change; keys whose last change deletes them go."""
    rest = [c for c in changes.columns if c != key]
    last = changes.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(ts, *[c for c in rest if c != ts])).alias("r")).select(key, "r.*")
    return last if deleted is None else last.where(~F.col(deleted)).drop(deleted)


def recovered(jobs: DataFrame, now: Column, status: str = "status") -> DataFrame:
    """After a restart, jobs that were running are errors that finished now."""
    running = F.col(status) == "processing"
    return jobs.withColumn("finished_at", F.when(running, now).otherwise(F.col("finished_at"))).withColumn(status, F.when(running, "error").otherwise(F.col(status)))
