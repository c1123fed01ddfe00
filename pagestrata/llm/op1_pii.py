"""Personal data by patterns, and terms that give it away by information theory.

Only DataFrame functions: matches and the pieces between them give every span's
place. A protected entity c (an address or number) is disclosed by a term t
that stands near it if knowing t yields nearly all of c's information: with
document frequencies, PMI(c; t) / IC(c) reaches `disclosure`, where PMI is
log2(n_ct N / (n_c n_t)) and IC is log2(N / n_c). Terms have to stand near c in
`support` different texts, or surroundings of one; copies of one text count once
in both, a passage that different texts share counts in each. Such terms are added as spans wherever they occur, and are removed like the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_view, scratch, written

#: The kinds in their order, and a pattern of each. Possessive
#: repeats match what plain ones do here and neither recurse nor backtrack.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GATES = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
BYTE = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.|$)){4}$"
#: A term is a whole run of letters, marks and digits of any length; frequent ones fail by their PMI.
TERM = r"[\p{L}\p{M}\p{N}]++"
SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


#: Items that a fold goes over at a time, so that no array grows item by item beyond it.
RUN = 256


def let(value: Column, f) -> Column:
    """f of a value that is computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def folded(items: Column, start: Column, kind: str, step) -> Column:
    """Elements in order of a fold over items: step(state, item) gives the next state and an array of none or one element. Linear in the items."""

    def over(all_: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size(all_) - 1, F.lit(0)) / RUN).cast("int")), lambda k: F.slice(all_, k * RUN + 1, RUN))
        none = F.array().cast(kind)

        def item(acc, x):
            state, out = step(acc["state"], x)
            return F.struct(state.alias("state"), F.concat(acc["out"], out).alias("out"))

        def run(acc, xs):
            inner = F.aggregate(xs, F.struct(acc["state"].alias("state"), none.alias("out")), item)
            return let(inner, lambda r: F.struct(r["state"].alias("state"), F.concat(acc["out"], F.array(r["out"])).alias("out")))

        return F.aggregate(runs, F.struct(start.alias("state"), F.array().cast(f"array<{kind}>").alias("out")), run, lambda a: F.flatten(a["out"]))

    return let(items, over)


def matches(text: Column, pattern: str, kind: int) -> Column:
    """All matches as (start, kind, end, value), in order; code points, end exclusive."""
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("before"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))

    def step(at, x):
        start = at + F.length(x["before"])
        end = start + F.length(x["found"])
        one = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["found"].alias("value"))
        none = F.array().cast(SPAN)
        return F.coalesce(end, at), F.when(x["found"].isNull(), none).otherwise(F.array(one).cast(SPAN))

    return folded(zipped, F.lit(0), SPAN, step)


def spans_of(text: Column, pattern: str, kind: int, gate: str) -> Column:
    return F.when(text.rlike(gate), matches(text, pattern, kind)).otherwise(F.array().cast(SPAN))


def luhn(digits: Column) -> Column:
    def part(c, i):
        d = F.ascii(c) - F.lit(48)
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, twice).otherwise(d)

    each = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), part)
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def holds(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(BYTE)
    if kind == "card":
        return F.length(digits).between(14, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Spans of all kinds in order of start and kind."""
    def kept(i: int, kind: str) -> Column:
        return F.filter(spans_of(text, PATTERNS[kind], i, GATES[kind]), lambda s: holds(kind, s["value"]))

    found = [kept(i, k) for i, k in enumerate(KINDS)]
    return F.array_sort(F.concat(*found))


def label(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in (*KINDS, "term")])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def entity(span: Column) -> Column:
    value = F.when(span["kind"] == 0, F.lower(span["value"])).otherwise(F.regexp_replace(span["value"], "[^0-9.]", ""))
    return F.xxhash64(span["kind"], value)


def terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def disclosing(found: DataFrame, reach: int, support: int, disclosure: float, broadcast_rows: int) -> DataFrame:
    """Terms that disclose an entity. found: doc_id, th, text, base. Written."""
    hits = found.where(F.size("base") > 0).select("th", "text", F.explode("base").alias("s"))
    # One more character than `reach` on each side says whether the window cuts a word; where the text itself ends, nothing is cut.
    left = F.expr(f"substring(text, greatest(s.start - {reach + 1}, 0) + 1, least(s.start, {reach + 1}))")
    right = F.expr(f"substring(text, s.end + 1, {reach + 1})")
    whole = lambda side, edge: F.when(F.length(side) > reach, F.regexp_replace(side, edge, "")).otherwise(side)
    around = F.concat_ws(" ", whole(left, rf"(?s)^(?:{TERM}|.)"), whole(right, rf"(?s)(?:{TERM}|.)\z"))
    near = written(hits.select("th", entity(F.col("s")).alias("e"), around.alias("around")).select("th", "e", F.xxhash64("around").alias("ctx"), terms(F.col("around")).alias("ts")))
    n_e = near.groupBy("e").agg(F.count_distinct("th").alias("n_e"), F.count_distinct("ctx").alias("k")).where(F.greatest("n_e", "k") >= support)
    pairs = near.join(n_e, "e").select("th", "e", "ctx", "n_e", F.explode("ts").alias("t")).groupBy("t", "e").agg(F.first("n_e").alias("n_e"), F.count_distinct("th").alias("n_te"), F.count_distinct("ctx").alias("k")).where(F.greatest("n_te", "k") >= support)
    total = F.lit(float(max(found.select("th").distinct().count(), 1)))
    # A term's documents are at least those it stands in near any entity: what then can't reach the threshold goes.
    least = near.select("th", F.explode("ts").alias("t")).groupBy("t").agg(F.count_distinct("th").alias("least"))
    ic = F.log2(total / F.col("n_e"))
    pmi = lambda n_t: F.log2(F.col("n_te") * total / (F.col("n_e") * F.col(n_t)))
    tells = lambda n_t: (ic > 0) & (pmi(n_t) >= F.lit(disclosure) * ic)
    pairs = written(pairs.join(least, "t").where(tells("least")).select("t", "e", "n_e", "n_te"))
    cand = pairs.select("t").distinct()
    n_cand = cand.count()
    side = F.broadcast(cand) if n_cand <= broadcast_rows else cand  # at most so many terms of `reach` letters
    n_t = found.select("th", F.explode(terms(F.col("text"))).alias("t")).join(side, "t").groupBy("t").agg(F.count_distinct("th").alias("n_t"))
    told = pairs.join(n_t, "t").where(tells("n_t")) if n_cand else pairs.limit(0)
    return written(told.select("t").distinct())


def find_pii(docs: DataFrame, reach: int = 80, support: int = 3, disclosure: float = 0.95, broadcast_rows: int = 100_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, base and all spans (arrays of start, kind, end, value), one row per input row.

    A null or empty text has no spans. Documents count by their text: repeated
    rows are one when frequencies are estimated, and each has its result.
    """
    view = doc_view(docs, id_col, text_col)
    found = view.select("doc_id", "text", F.xxhash64("text").alias("th"), base_spans(F.col("text")).alias("base"))
    with scratch(docs.sparkSession) as keep:
        said = _told_matches(view, found, reach, support, disclosure, broadcast_rows)
        if said is None:
            return found.select("doc_id", "text", "base", F.col("base").alias("spans"))
        said = keep(said)
    few = said.agg(F.count("*").alias("n"), F.sum(F.size("said")).alias("k")).first()
    known = F.broadcast(said) if (few["n"] or 0) + (few["k"] or 0) <= broadcast_rows else said
    both = found.join(known, F.col("th") == F.col("h"), "left")
    extra = F.coalesce(F.col("said").cast(SPAN), F.array().cast(SPAN))
    return both.select("doc_id", "text", "base", F.array_sort(F.concat("base", extra)).alias("spans"))


def _told_matches(view: DataFrame, found: DataFrame, reach: int, support: int, disclosure: float, broadcast_rows: int) -> DataFrame | None:
    """(h, said): the matches of disclosing terms in each text that holds some; None without any.

    Only texts with a told term are looked at, once each, and their matches
    meet the terms in a join: linear in the matches, however many terms are told.
    """
    told = disclosing(found, reach, support, disclosure, broadcast_rows)
    n = told.count()
    if not n:
        return None
    side = F.broadcast(told) if n <= broadcast_rows else told
    held = view.select(F.xxhash64("text").alias("h"), F.explode(terms(F.col("text"))).alias("t")).join(side, "t").select("h").distinct()
    texts = view.select(F.xxhash64("text").alias("h"), "text").join(written(held), "h", "left_semi").dropDuplicates(["h"])
    each = texts.select("h", F.explode(matches(F.col("text"), TERM, len(KINDS))).alias("m")).select("h", "m", F.lower(F.col("m.value")).alias("t"))
    return each.join(side, "t").groupBy("h").agg(F.collect_list("m").alias("said"))


def sanitise(found: DataFrame) -> DataFrame:
    """doc_id and clean_text: base spans generalised to their kind's name, disclosing terms removed; overlaps are one cut."""
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS], F.lit(""))
    cut = "array<struct<start:int,end:int,name:string>>"

    def step(at, s):
        one = F.array(F.struct(at.alias("start"), F.greatest(s["start"], at).alias("end"), F.get(names, s["kind"]).alias("name"))).cast(cut)
        return F.greatest(at, s["end"]), F.when(s["end"] <= at, F.array().cast(cut)).otherwise(one)

    kept = F.transform(folded(F.col("spans"), F.lit(0), cut, step), lambda c: F.concat(F.substr(F.col("text"), c["start"] + 1, c["end"] - c["start"]), c["name"]))
    last = F.coalesce(F.array_max(F.transform("spans", lambda s: s["end"])), F.lit(0))
    return found.select("doc_id", F.concat(F.array_join(kept, ""), F.substr(F.col("text"), last + 1, F.length("text"))).alias("clean_text"))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns."""
    def count(i: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")

    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(label(F.col("base")), 256).alias("base_sha256"), label(F.col("spans")).alias("spans"))
