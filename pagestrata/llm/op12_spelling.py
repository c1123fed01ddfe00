"""Spelling variants of a corpus' words: words one edit apart, and the form each belongs to.

Even partition and pigeonhole: of a word and its indexed neighbour of length l,
cut in a first part of l // 2 code points and the rest, one edit leaves one part
untouched. So words are indexed under both parts with l; a word of l or l + 1
code points probes with its first l // 2 and with its last l - l // 2 ones, the
same places moved by the difference in length. Where many words share a part
("-tion"), what is left of them is cut evenly again and again, which narrows
the group by the same argument, until a group gives few candidates or one code
point is open. So nothing is left out and no group gives all its pairs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch, written

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def corpus_words(docs: DataFrame, least_length: int = 5, least_count: int = 3, one_of: int = 97, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the runs of letters of all texts with their number of occurrences.

    Of one run in `one_of`, told by the checksum of its document and itself, one
    code point is taken out (one_of=0: of none). A null id counts as the empty string.
    """
    runs = docs.select(F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("d"), F.explode(F.regexp_extract_all(F.translate(docs[text_col].cast("string"), UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.char_length("run") >= least_length)
    word = F.col("run")
    if one_of:
        h = F.crc32(F.concat("d", F.lit(":"), "run"))
        at = (h % F.char_length("run")).cast("int")
        word = F.when(h % one_of == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))).otherwise(word)
    counted = runs.select(word.alias("word")).where(F.char_length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least_count)


def _part(l: Column, s: Column, r: Column) -> Column:
    """The key of what two words agree on: the indexed length and all but r code points from place s on."""
    return F.xxhash64(l, F.substring("word", F.lit(1), s), F.substring("word", s + r + 1, F.char_length("word")))


def _halved(entries: DataFrame) -> DataFrame:
    """Entries (word, l, s, r) with r open code points from place s on, each with one half of them closed, and their key."""
    open_ = F.col("r") - (F.char_length("word") - F.col("l"))  # of the indexed word
    first = F.floor(open_ / 2).cast("int")
    sides = F.array(F.struct((F.col("s") + first).alias("s"), (F.col("r") - first).alias("r")), F.struct(F.col("s").alias("s"), (F.col("r") - (open_ - first)).alias("r")))
    one = entries.select("word", "l", F.explode(sides).alias("_side")).select("word", "l", "_side.s", "_side.r")
    return one.select(_part(F.col("l"), F.col("s"), F.col("r")).alias("key"), "word", "l", "s", "r")


def near_words(words: DataFrame, crowd: int = 16) -> DataFrame:
    """(a, b): words exactly one inserted, deleted or replaced code point apart, each pair once, the indexed one first.

    A group of `crowd` candidates a word or fewer is verified as it is. Written.
    """
    size = F.char_length("word")
    own = words.select("word", F.explode(F.array(size, size - 1)).alias("l")).where("l > 0").select("word", "l", F.lit(0).alias("s"), size.alias("r"))
    entries, found = written(_halved(own)), []
    while True:
        index = F.char_length("word") == F.col("l")
        sizes = entries.groupBy("key").agg(F.count_if(index).alias("m"), F.count_if(~index).alias("p"), F.max(F.col("r") - F.char_length("word") + F.col("l")).alias("open"))
        sizes = sizes.where("m > 1 or (m = 1 and p > 0)")  # others have no pair
        pairs = F.col("m") * (F.col("m") - 1) / 2 + F.col("m") * F.col("p")
        told = written(entries.join(sizes.select("key", ((F.col("open") > 1) & (pairs > crowd * (F.col("m") + F.col("p")))).alias("crowded")), "key"))
        few = told.where("not crowded")
        a = few.where(index).select("key", F.col("word").alias("a"))
        b = few.select("key", F.col("word").alias("b"))
        apart = (F.char_length("a") < F.char_length("b")) | (F.col("a") < F.col("b"))
        found.append(written(a.join(b, "key").where(apart).where(F.levenshtein("a", "b", 1) == 1).select("a", "b")))
        rest = told.where("crowded")
        if rest.isEmpty():
            return written(reduce(DataFrame.union, found).distinct())
        entries = written(_halved(rest))


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) to (word, root): forms followed to the last one. A form is more frequent than its word, so there are no cycles; each round doubles the steps taken."""
    step = written(forms.select("word", F.col("form").alias("root")))
    while True:
        further = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = written(step.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        step = step.drop("moved")


def spelling_groups(docs: DataFrame, least_length: int = 5, least_count: int = 3, times: int = 2, one_of: int = 97, crowd: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n: every word of the corpus.

    Its form is the most frequent word one edit away (of equals the smallest by
    code points), if that occurs `times` as often as the word at least. Null
    and empty texts have no words, repeated rows count each; without words the
    result is empty. Only the id and the text are read.
    """
    with scratch(docs.sparkSession) as keep:
        words = written(corpus_words(docs, least_length, least_count, one_of, id_col, text_col))
        near = near_words(words, crowd)
        both = near.union(near.select("b", "a"))
        counted = both.join(words.select(F.col("word").alias("b"), "n"), "b")
        best = counted.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), "b")).alias("top"))
        chosen = F.when(-F.col("top.less") >= times * F.col("n"), F.struct(F.col("top.b").alias("form"), (-F.col("top.less")).alias("form_n")))
        formed = written(words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), chosen.alias("c")).select("word", "n", "n_near", "c.form", "c.form_n"))
        last = roots(formed.where("form is not null"))
        return keep(formed.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
