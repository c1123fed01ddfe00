"""Quality rules: an isolation forest over rule statistics of each text.

Statistics are computed in one pass per text, as shares and sizes on a
logarithmic scale. Each rule has bounds, between which nearly all labelled good
rows lie; a row is what it exceeds them by, for all rules at once, 0 within. One
forest is grown on these rows: each split chooses a statistic and a place at random, so a
row that is far off in one of them, or somewhat in several, is soon alone. Its
mean path over all trees is its score. Bounds and trees come from one half of
all labelled rows, the path below which a document is rejected from the other.
Both are counted on Spark over the whole halves; as the method wants it, each
tree is grown from a few rows of its own, drawn from all of its half.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import doc_view, scratch, written

SYMBOLS = b"#*$%&|<>"
KEEP_SYMBOLS = bytes(b for b in range(256) if b not in SYMBOLS)
MARKS = b"!?:;"
UPPER = bytes(range(0x41, 0x5B))
#: The rules' statistics: shares of characters, lines and words in percent, and sizes, as logarithms.
FEATURES = ("symbols", "marks", "upper", "word_len", "dup_lines", "repeat_words", "words")
STATS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, features array<double>"


def text_stats(text: str) -> tuple[int, int, int, int, int, list[float]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the forest's features."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # blanks of bytes.split() are \x20 and \x09-\x0D
    n = len(words)
    packed = b"".join(words)
    chars = len(packed.decode("utf-8", "surrogatepass"))
    symbols = len(raw.translate(None, KEEP_SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    repeat = 0
    if n > 3:
        grams = Counter(zip(words, words[1:], words[2:]))
        if len(grams) < n - 2:
            upto = 0
            for i, g in enumerate(zip(words, words[1:], words[2:])):
                if grams[g] > 1:
                    repeat += i + 3 - max(upto, i)
                    upto = i + 3
    w = max(n, 1)
    upper = len(packed) - len(packed.translate(None, UPPER))
    marks = len(packed) - len(packed.translate(None, MARKS))
    c = max(chars, 1)
    shares = symbols / c, marks / c, upper / c, dup_lines / max(len(lines), 1), repeat / w
    symbols_, marks_, upper_, dup_, repeat_ = (math.log1p(100 * x) for x in shares)
    features = [symbols_, marks_, upper_, math.log(c / w), dup_, repeat_, math.log(w)]
    return n, chars, symbols, dup_lines, repeat, features


def with_stats(view: DataFrame) -> DataFrame:
    """doc_id and the statistics, one row per row of (doc_id, text)."""

    def run(batches):
        for batch in batches:
            rows = [text_stats(t.as_py()) for t in batch.column(1)]
            cols = [pa.array([r[k] for r in rows], pa.int64()) for k in range(5)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols, pa.array([r[5] for r in rows], pa.list_(pa.float64()))], names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "features"])

    return view.mapInArrow(run, STATS)


class IsolationForest:
    """Trees over all columns, as flat arrays; scoring walks all rows down a tree level by level."""

    def __init__(self, trees: int = 256, sample: int = 64, few: int = 4, seed: int = 7):
        self.trees, self.sample, self.few, self.seed = trees, sample, few, seed

    def fit(self, x: np.ndarray, good: np.ndarray) -> IsolationForest:
        """Each tree from a sample with at most `few` bad rows, so that these are the ones that random splits part soon."""
        rng = np.random.default_rng(self.seed)
        ok, bad = np.flatnonzero(good), np.flatnonzero(~good)
        n_bad = min(len(bad), self.few)
        height = max(1, math.ceil(math.log2(self.sample)))
        self.grown = []
        for _ in range(self.trees):
            rows = np.concatenate([rng.choice(ok, min(self.sample - n_bad, len(ok)), replace=False), rng.choice(bad, n_bad, replace=False)])
            self.grown.append(self._grow(x[rows], rng, height))
        return self

    def grow(self, samples: Sequence[np.ndarray]) -> IsolationForest:
        """Each tree from its sample."""
        rng = np.random.default_rng(self.seed)
        height = max(1, math.ceil(math.log2(self.sample)))
        self.grown = [self._grow(x, rng, height) for x in samples]
        return self

    def _grow(self, rows: np.ndarray, rng, height: int):
        feature, value, left, right, length = [], [], [], [], []

        def node(part: np.ndarray, depth: int) -> int:
            k = len(feature)
            for a, v in ((feature, 0), (value, math.inf), (left, k), (right, k), (length, depth + average_path(len(part)))):
                a.append(v)
            lo, hi = part.min(0), part.max(0)
            open_ = np.flatnonzero(hi > lo)
            if depth >= height or len(part) < 2 or not len(open_):
                return k
            f = int(rng.choice(open_))
            v = float(rng.uniform(lo[f], hi[f]))
            go = part[:, f] <= v
            feature[k], value[k] = f, v
            left[k], right[k] = node(part[go], depth + 1), node(part[~go], depth + 1)
            return k

        node(rows, 0)
        return tuple(np.array(a) for a in (feature, value, left, right, length)) + (height,)

    def paths(self, x: np.ndarray) -> np.ndarray:
        """Mean path length of each row over all trees; short is anomalous. Equal rows are walked once."""
        rows, of = np.unique(x, axis=0, return_inverse=True)
        flat, first = np.ascontiguousarray(rows).ravel(), np.arange(len(rows)) * x.shape[1]
        out = np.zeros(len(rows))
        for feature, value, left, right, length, height in self.grown:
            at = np.zeros(len(rows), dtype=np.int64)
            for _ in range(height):
                at = np.where(flat[first + feature[at]] <= value[at], left[at], right[at])
            out += length[at]
        return (out / self.trees)[of.ravel()]


class Rules:
    """Bounds of each statistic, from good rows, and what rows exceed them by, in the rows' standard deviations."""

    def __init__(self, good: np.ndarray, share: float):
        self.low, self.high = np.quantile(good, 1 - share, axis=0, method="lower"), np.quantile(good, share, axis=0, method="higher")  # of few rows all
        self.unit = np.maximum(good.std(axis=0), 1e-6)

    @classmethod
    def of(cls, low: Sequence[float], high: Sequence[float], deviations: Sequence[float]) -> Rules:
        rules = cls.__new__(cls)
        rules.low, rules.high, rules.unit = np.array(low), np.array(high), np.maximum(np.array(deviations), 1e-6)
        return rules

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (np.maximum(x - self.high, 0) - np.maximum(self.low - x, 0)) / self.unit


def average_path(n: int) -> float:
    """Mean depth of an unsuccessful search among n rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def threshold(paths: np.ndarray, good: np.ndarray, spare: float, least: float) -> float:
    """The path length below which a text is rejected: at most the share `spare` of good rows lies below it.

    Between that bound and the largest bad path below it the middle is taken,
    so that the bound has room on both sides. Nothing is rejected without good
    or bad rows, or where fewer than the share `least` of the bad ones is told apart.
    """
    if not good.any() or good.all():
        return -math.inf
    bound = float(np.quantile(paths[good], spare, method="lower"))
    bad = paths[~good]
    below = bad[bad < bound]
    return between(bound, len(below), float(below.max(initial=-math.inf)), len(bad), least)


def between(bound: float, n_below: int, highest: float, n_bad: int, least: float) -> float:
    """The threshold from the good rows' bound, the bad paths below it and the largest of these."""
    return (highest + bound) / 2 if n_below >= max(1, least * n_bad) else -math.inf


def base_failed(n_words, n_repeat_words, min_words: int = 50, max_repeat: float = 0.5):
    """The base rules; for columns and for numbers."""
    return (n_words < min_words) | (100 * n_repeat_words > 100 * max_repeat * n_words)


Model = tuple[Rules, IsolationForest, float]


def fitted(x: np.ndarray, good: np.ndarray, held: np.ndarray, trees: int, within: float, spare: float, least: float) -> Model:
    """Bounds and trees from the rows that aren't held out, the threshold from those that are; from all where either part lacks a label."""
    parts = [~held, held] if all(len(set(good[p])) == 2 for p in (held, ~held)) else [np.ones(len(x), bool)] * 2
    grow, told = parts
    rules = Rules(x[grow & good], within)
    forest = IsolationForest(trees).fit(rules(x[grow]), good[grow])
    return rules, forest, threshold(forest.paths(rules(x[told])), good[told], spare, least)


def order_statistics(rows: DataFrame, wanted: Sequence[tuple[Column, int]], bins: int = 1024) -> list[float]:
    """For each (column, rank) the value that `rank` of all the column's values come before, exactly.

    The range that holds it is counted in `bins` parts, and the part that it
    lies in becomes the range, until that is one value. Only counts reach the driver.
    """
    each = rows.select(F.posexplode(F.array(*[c for c, _ in wanted])).alias("t", "v"))
    ends = {r["t"]: r for r in each.groupBy("t").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).collect()}
    at = [(ends[t]["lo"], ends[t]["hi"], rank) for t, (_, rank) in enumerate(wanted)]
    while any(lo < hi for lo, hi, _ in at):
        lo, hi = (F.get(F.array(*[F.lit(x[k]) for x in at]), F.col("t")) for k in (0, 1))
        near = each.where((lo < hi) & F.col("v").between(lo, hi)).withColumn("part", F.floor((F.col("v") - lo) / (hi - lo) * bins))
        found = near.groupBy("t", "part").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
        ranks, before = [rank for _, _, rank in at], dict.fromkeys(range(len(at)), 0)
        for r in sorted(found, key=lambda r: (r["t"], r["part"])):
            rank = ranks[r["t"]] - before[r["t"]]
            if 0 <= rank < r["n"]:
                at[r["t"]] = (r["lo"], r["hi"], rank)
            before[r["t"]] += r["n"]
    return [lo for lo, _, _ in at]


def drawn(rows: DataFrame, n: int, trees: int, want: int, seed: int) -> list[list[list[float]]]:
    """For each tree `want` of the n rows (all of fewer): those with the smallest hashes of id and tree. A row is only a candidate where its hash is small enough for several times as many."""
    want = min(want, n)
    h = lambda t: F.xxhash64("doc_id", F.lit(seed), t)
    w = Window.partitionBy("tree").orderBy("h", "doc_id", "features")
    for share in (min(1.0, (4 * want + 64) / max(n, 1)), 1.0):
        near = lambda t: h(t).cast("double") <= (2 * share - 1) * 2.0**63  # noqa: E731,B023
        tickets = rows.select("doc_id", "features", F.explode(F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), near)).alias("tree")).withColumn("h", h(F.col("tree")))
        out: list[list[list[float]]] = [[] for _ in range(trees)]
        for r in tickets.withColumn("r", F.row_number().over(w)).where(F.col("r") <= want).orderBy("tree", "r").select("tree", "features").collect():
            out[r["tree"]].append(r["features"])
        if all(len(x) == want for x in out):
            break
    return out


def alternating(rows: DataFrame) -> DataFrame:
    """rows with held: every other one in the order of a hash of its id. Rows are numbered within 1,024 ranges of that hash, which start where the ranges before end."""
    h = F.xxhash64("doc_id")
    t = rows.withColumn("_range", F.shiftright(h, 54))
    starts = t.groupBy("_range").agg(F.count("*").alias("_n")).withColumn("_before", F.sum("_n").over(Window.orderBy("_range")) - F.col("_n"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(h, "doc_id", "features")) - 1
    return t.withColumn("_place", place).join(starts, "_range").withColumn("held", (F.col("_before") + F.col("_place")) % 2 == 1).drop("_range", "_n", "_before", "_place")


def calibrate(docs: DataFrame, labels: DataFrame, trees: int = 256, within: float = 0.999, spare: float = 0.001, least: float = 0.02, id_col: str = "doc_id", text_col: str = "text", stats: DataFrame | None = None) -> Model | None:
    """Rules, forest and threshold from all labelled rows, every other one in the order of a hash of their id held out of the growing. stats: with_stats of docs, if it is at hand.

    Only rows that pass the base rules count. None without rows of both labels.
    """
    with scratch(docs.sparkSession):
        stats = with_stats(doc_view(docs, id_col, text_col)) if stats is None else stats
        marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
        known = written(alternating(stats.where(~base_failed(F.col("n_words"), F.col("n_repeat_words"))).join(marked, "doc_id").select("doc_id", "features", (F.col("quality") == 1).alias("good"))))
        counts = {(r["held"], r["good"]): r["n"] for r in known.groupBy("held", "good").agg(F.count("*").alias("n")).collect()}
        n = lambda good, half=None: sum(c for (h, g), c in counts.items() if g == good and half in (None, h))
        if not n(True) or not n(False):
            return None
        halves = len(counts) == 4
        grow, told = (known.where("not held"), known.where("held")) if halves else (known, known)
        n_good, n_bad = (n(g, False if halves else None) for g in (True, False))
        good = grow.where("good")
        feature = [F.get("features", F.lit(k)) for k in range(len(FEATURES))]
        first, last = math.floor((n_good - 1) * (1 - within)), math.ceil((n_good - 1) * within)
        bounds = order_statistics(good, [(f, first) for f in feature] + [(f, last) for f in feature])
        rules = Rules.of(bounds[: len(feature)], bounds[len(feature) :], list(good.agg(*[F.stddev_pop(f) for f in feature]).first()))
        forest = IsolationForest(trees)
        few = drawn(grow.where("not good"), n_bad, trees, forest.few, forest.seed)
        many = drawn(good, n_good, trees, forest.sample - min(n_bad, forest.few), forest.seed)
        forest.grow([rules(np.array(a + b)) for a, b in zip(many, few)])
        shared = docs.sparkSession.sparkContext.broadcast((rules, forest, 0.0))

        @F.pandas_udf("double")
        def path(features: pd.Series) -> pd.Series:
            return pd.Series(margins(shared.value, np.stack(features.to_numpy())) if len(features) else [], dtype="float64")

        paths = written(told.select("good", path("features").alias("path")))
        of_good, of_bad = (n(g, True if halves else None) for g in (True, False))
        bound = order_statistics(paths.where("good"), [(F.col("path"), math.floor((of_good - 1) * spare))])[0]
        below = paths.where(~F.col("good") & (F.col("path") < bound)).agg(F.count("*").alias("n"), F.max("path").alias("top")).first()
        return rules, forest, between(bound, below["n"], below["top"] if below["n"] else -math.inf, of_bad, least)


def margins(model: Model, x: np.ndarray) -> np.ndarray:
    """How far each row's mean path stays above the threshold; below 0 is an anomaly."""
    rules, forest, cut = model
    return forest.paths(rules(x)) - cut


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """doc_id, the statistics, base_failed, margin (see margins; null without a forest), kept; one row per input row.

    `how` is for calibrate. Without labels (or none that match) the base rules
    decide alone. The statistics are written once; that table stays, as the result reads it. A null or empty text has no words and fails them.
    """
    stats = written(with_stats(doc_view(docs, id_col, text_col)))
    model = calibrate(docs, labels, stats=stats, **how)
    stats = stats.withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))
    if model is None:
        return stats.withColumn("margin", F.lit(None).cast("double")).withColumn("kept", ~F.col("base_failed")).drop("features")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def margin(features: pd.Series) -> pd.Series:
        return pd.Series(margins(shared.value, np.stack(features.to_numpy())) if len(features) else [], dtype="float64")

    return stats.withColumn("margin", margin("features")).withColumn("kept", ~F.col("base_failed") & (F.col("margin") >= 0)).drop("features")


def good_documents(docs: DataFrame, labels: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The rows of docs that the rules keep, as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(calibrate(docs, labels, text_col=text_col, **how))

    @F.pandas_udf("boolean")
    def good(texts: pd.Series) -> pd.Series:
        stats = [text_stats(t or "") for t in texts]
        ok = np.array([not base_failed(s[0], s[4]) for s in stats], dtype=bool)
        if shared.value is not None and len(stats):
            ok &= margins(shared.value, np.array([s[5] for s in stats])) >= 0
        return pd.Series(ok)

    return docs.where(good(F.coalesce(docs[text_col].cast("string"), F.lit(""))))
