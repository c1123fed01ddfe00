"""Near-duplicate classes by Order MinHash.

The k-mers are runs of five words, labelled by their occurrence in the text. Of
each of `sketches` random orders of the labelled k-mers the first `picks` are
taken and set back into text order; texts that agree in one such tuple are
candidates. A candidate pair is verified by a banded alignment of the two k-mer
sequences: with m matches in order, the similarity m / (n_a + n_b - m) has to
reach the threshold. It is Jaccard's on labelled k-mers if the common ones are
in one order, and less otherwise.

Only distinct texts are compared. Texts of a tuple are first parted by their
count of k-mers, as similar ones differ by no more than the threshold allows;
such a part is a bucket. In a bucket every text is compared with the bucket's
hub first. Texts of buckets that then hold several classes are compared where
they share one of their rarest k-mers, under which any two similar texts meet,
in blocks of bounded size: no link that the buckets offer between classes is
lost and no task sees a whole hot bucket.
"""

from __future__ import annotations

import math
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BASES, doc_view, gram_hashes, mix, slices, scratch, span_hashes, text_key, words_of, written
from .components import components, joined

WORDY = r"[^\x20\x09-\x0D]"
FULL = np.uint64((1 << 64) - 1)


def kmers(data: np.ndarray, offs: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Occurrence-labelled k-mers of all texts in order, and each text's first (n + 1). A shorter text, if it has words, is one k-mer."""
    starts, ends, first = words_of(data, offs)
    h = span_hashes(data, starts, ends)
    n_words = np.diff(first)
    counts = np.where(n_words >= k, n_words - k + 1, (n_words > 0).astype(np.int64))
    upto = np.concatenate([[0], np.cumsum(counts)])
    doc = np.repeat(np.arange(len(counts)), counts)
    grams = np.empty(len(doc), np.uint64)
    long_ = n_words[doc] >= k
    at = first[doc] + np.arange(len(doc)) - upto[doc]
    grams[long_] = gram_hashes(h, k)[at[long_]] if long_.any() else 0
    for d in np.flatnonzero((n_words > 0) & (n_words < k)):
        own = h[first[d] : first[d + 1]]
        grams[upto[d]] = gram_hashes(own, len(own))[0] ^ np.uint64(len(own))
    key = grams ^ mix(doc.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    sorted_ = key[order]
    new = np.ones(len(order), bool)
    new[1:] = sorted_[1:] != sorted_[:-1]
    index = np.arange(len(order))
    occurrence = np.empty(len(order), np.uint64)
    occurrence[order] = (index - np.maximum.accumulate(np.where(new, index, 0))).astype(np.uint64)
    return mix(grams + occurrence * np.uint64(BASES[0])), upto


def order_sketches(grams: np.ndarray, upto: np.ndarray, sketches: int, picks: int, seed: int = 1) -> np.ndarray:
    """A (texts, sketches) array of tuples' hashes; rows of texts without k-mers are 0."""
    counts = np.diff(upto)
    out = np.zeros((len(counts), sketches), np.uint64)
    has = np.flatnonzero(counts)
    if not len(has):
        return out
    doc = np.repeat(np.arange(len(counts)), counts)
    share = np.minimum(1.0, 16.0 / np.maximum(counts, 1))
    bar = np.where(share >= 1.0, FULL, (share * float(1 << 63)).astype(np.uint64) << np.uint64(1))[doc]
    keys = mix(np.arange(2 * sketches, dtype=np.uint64) + np.uint64(seed << 20))
    for i in range(sketches):
        v = (grams ^ keys[2 * i]) * (keys[2 * i + 1] | np.uint64(1))
        v ^= v >> np.uint64(29)
        v *= np.uint64(0xBF58476D1CE4E5B9)
        cand = np.flatnonzero(v <= bar)
        n_cand = np.bincount(doc[cand], minlength=len(counts))
        short = np.flatnonzero(n_cand < np.minimum(counts, picks))
        if len(short):  # too few below the bar: all k-mers of these texts are candidates
            cand = np.union1d(cand, np.flatnonzero(np.isin(doc, short)))
        cand = cand[np.lexsort((v[cand], doc[cand]))]
        owner = doc[cand]
        start = np.searchsorted(owner, has)
        rank = np.arange(len(cand)) - np.repeat(start, np.diff(np.append(start, len(cand))))
        taken = np.sort(cand[rank < picks])
        owner = doc[taken]
        start = np.searchsorted(owner, has)
        place = (np.arange(len(taken)) - np.repeat(start, np.diff(np.append(start, len(taken))))).astype(np.uint64)
        total = np.add.reduceat(mix(grams[taken] + (place + np.uint64(1)) * np.uint64(BASES[1])), start)
        out[has, i] = mix(total ^ keys[2 * i])
    return out


def similarity(a: np.ndarray, b: np.ndarray, at_least: float, a_order=None, b_order=None) -> float:
    """m / (n_a + n_b - m) for the longest common subsequence m of two sequences of distinct k-mers; 0 if below at_least.

    Only matches inside the band count: with this similarity at most
    (n_a + n_b) (1 - s) / (1 + s) k-mers stand outside the alignment, so matched
    places differ by no more.
    """
    n_a, n_b = len(a), len(b)
    if min(n_a, n_b) < at_least * max(n_a, n_b) or not n_a or not n_b:
        return 0.0
    band = (n_a + n_b) * (1 - at_least) / (1 + at_least) + 1e-9
    a_order = np.argsort(a) if a_order is None else a_order
    at = np.searchsorted(a[a_order], b)
    at[at == n_a] = 0
    at = a_order[at]
    hit = np.flatnonzero(a[at] == b)
    at = at[hit]
    at = at[np.abs(at - hit) <= band]
    if len(at) < at_least * (n_a + n_b - len(at)):
        return 0.0
    if (np.diff(at) > 0).all():
        m = len(at)
    else:
        tails: list[int] = []
        for x in at.tolist():
            k = bisect_left(tails, x)
            tails[k : k + 1] = [x]
        m = len(tails)
    s = m / (n_a + n_b - m)
    return s if s >= at_least else 0.0


def sketch_table(base: DataFrame, k: int, sketches: int, picks: int) -> DataFrame:
    """(sig, fp, n), one row for each text and sketch; n is the text's count of k-mers."""

    def run(batches):
        for batch in batches:
            fps = batch.column(0)
            for lo, hi, data, offs in slices(batch.column(1)):
                grams, upto = kmers(data, offs, k)
                sk = order_sketches(grams, upto, sketches, picks)
                rows = np.repeat(np.flatnonzero(np.diff(upto)), sketches)
                yield pa.RecordBatch.from_arrays([pa.array(sk[np.diff(upto) > 0].ravel().view(np.int64)), fps.slice(lo, hi - lo).take(pa.array(rows)), pa.array(np.diff(upto)[rows])], names=["sig", "fp", "n"])

    return base.select("fp", "text").mapInArrow(run, "sig long, fp binary, n long")


#: K-mers that a block of texts holds at most, unless `LEAST` texts have more.
BLOCK_KMERS, LEAST = 4 << 20, 8


def block_rows(block: int, n: Column) -> Column:
    """Texts of up to n k-mers in a block."""
    return F.least(F.lit(block), F.greatest(F.floor(F.lit(BLOCK_KMERS) / F.greatest(n, F.lit(1))), F.lit(LEAST)))


def by_size(rows: DataFrame, at_least: float) -> DataFrame:
    """rows (sig, fp, n) to (bucket, fp, n): counts of k-mers in steps of 1 / at_least; a bucket holds two neighbouring steps, so any two texts of the similarity share one."""
    step = F.floor(F.log("n") / math.log(1 / at_least)).cast("int") if at_least < 1 else F.col("n").cast("int")
    return rows.select("fp", "n", F.explode(F.array(F.xxhash64("sig", step), F.xxhash64("sig", step + 1))).alias("bucket"))


def verified(blocks: DataFrame, k: int, at_least: float) -> DataFrame:
    """Links (a, b) inside blocks. blocks: block binary, role int (0: compared with all of role 1), label binary, fp binary, text string, and maybe ks.

    ks: the keys under which a text stands, in one order for all; a pair is
    compared under its first common one only. A pair of one label needs no comparison; once a link joins two labels in a
    block, they count as one there.
    """

    def run(batches):
        block, held = None, []

        def compare():
            done: dict[bytes, bytes] = {}

            def root(x):
                while done.get(x, x) != x:
                    x = done[x]
                return x

            out, listed = [], {}
            grams = {}
            key = int(block.split(b":")[0]) if held[0][4] is not None else None
            for _, _, fp, text, ks in held:
                if fp not in grams:
                    listed[fp] = ks and (ks, set(ks))
                    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
                    g = kmers(raw, np.array([0, len(raw)]), k)[0]
                    grams[fp] = (g, np.argsort(g))
            told = [h for h in held if h[0] == 1]
            for _, la, fa, _, ka in (h for h in held if h[0] == 0):
                for _, lb, fb, _, kb in told:
                    if fa == fb or root(la) == root(lb):
                        continue
                    if key is not None and next(filter(listed[fb][1].__contains__, ka)) != key:
                        continue
                    if similarity(grams[fa][0], grams[fb][0], at_least, grams[fa][1]):
                        out.append((fa, fb))
                        done[root(la)] = root(lb)
            return out

        def rows(pairs):
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in pairs], pa.binary()), pa.array([b for _, b in pairs], pa.binary())], names=["a", "b"])

        for batch in batches:
            for b, role, label, fp, text, ks in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if b != block:
                    if held and (pairs := compare()):
                        yield rows(pairs)
                    block, held = b, []
                held.append((role, label, fp, text, ks))
        if held and (pairs := compare()):
            yield rows(pairs)

    if "ks" not in blocks.columns:
        blocks = blocks.withColumn("ks", F.lit(None).cast("array<long>"))
    return blocks.repartition("block").sortWithinPartitions("block", "role", "fp").select("block", "role", "label", "fp", "text", "ks").mapInArrow(run, "a binary, b binary")


def hub_blocks(pairs: DataFrame, block: int) -> DataFrame:
    """(block, role, label, fp) for verified: each hub against its texts, dealt out in blocks. Written. pairs: fp, n, hub."""
    sizes = written(pairs.groupBy("hub").agg(F.ceil(F.count("*") / block_rows(block, F.max("n"))).cast("int").alias("parts")))
    name = lambda p: F.concat("hub", F.encode(p.cast("string"), "utf-8")).alias("block")
    mine = pairs.join(sizes, "hub").select(name(F.pmod(F.xxhash64("fp"), F.col("parts"))), F.lit(1).alias("role"), F.col("fp").alias("label"), "fp")
    hubs = sizes.select("hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("p")).select(name(F.col("p")), F.lit(0).alias("role"), F.col("hub").alias("label"), F.col("hub").alias("fp"))
    return written(mine.union(hubs))


#: Steps of a text's count of k-mers in which texts of similar size are looked up.
STEP = math.log(1.1)


def gram_rows(texts: DataFrame, k: int) -> DataFrame:
    """texts (fp, label, text) to (gram, fp, label, n), one row for each k-mer of a text; n is the text's count of them."""

    def run(batches):
        for batch in batches:
            for lo, hi, data, offs in slices(batch.column(2)):
                grams, upto = kmers(data, offs, k)
                own = np.diff(upto)
                rows = pa.array(np.repeat(np.arange(lo, hi), own))
                yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(np.repeat(own, own))], names=["gram", "fp", "label", "n"])

    return texts.select("fp", "label", "text").mapInArrow(run, "gram long, fp binary, label long, n long")


def shared_kmers(crowd: DataFrame, k: int, at_least: float) -> DataFrame:
    """crowd (fp, label, text) to (fp, label, n, shared): each text's k-mers that texts of other labels hold too, with the count of texts. Texts with too few of them for any similar text of another label are left out."""
    grams = gram_rows(crowd.select("fp", F.xxhash64("label").alias("label"), "text"), k)
    held = grams.groupBy("gram").agg(F.count("*").alias("c"), F.min("label").alias("one"), F.max("label").alias("other")).where("one <> other")
    found = grams.select("gram", "fp", "n").join(written(held.select("gram", "c")).hint("merge"), "gram")
    lists = found.groupBy("fp").agg(F.max("n").alias("n"), F.collect_list(F.struct("c", "gram")).alias("shared"))
    enough = lists.where(F.size("shared") >= at_least * F.col("n") - 1e-6)
    return crowd.select("fp", "label").join(enough.hint("merge"), "fp").select("fp", "label", "n", "shared")


def prefix_rows(texts: DataFrame, at_least: float) -> DataFrame:
    """texts of shared_kmers to (key, indexed, label, fp, n): where a text is to be found by texts as long or longer, and where it looks for shorter ones.

    In an order of all k-mers, those of one label first and then rare ones, let
    two texts of n_x <= n_y k-mers have their first common one at the places p_x
    and p_y. They share at most min(n_x - p_x, n_y - p_y), and similar ones
    a (n_x + n_y) with a = at_least / (1 + at_least). So x is indexed under its
    first k-mers only as far as a partner of its own size could still be
    similar, and y asks, for each of its first k-mers, in the steps of sizes
    that could. A key is a k-mer and a step. K-mers of one label only take
    places: no text of another label has them.
    """
    alpha = at_least / (1 + at_least)

    def run(batches):
        for batch in batches:
            ends = np.cumsum(batch.column(3).value_lengths().to_numpy())
            lo = 0
            while lo < len(ends):
                begin = ends[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(ends, begin + (1 << 18), side="right")))
                upto = np.append(begin, ends[lo:hi]) - begin
                listed = batch.column(3).slice(lo, hi - lo).flatten()
                count, grams = listed.field(0).to_numpy(), listed.field(1).to_numpy().view(np.uint64)
                own, total = np.diff(upto), batch.column(2).slice(lo, hi - lo).to_numpy()
                doc = np.repeat(np.arange(len(own)), own)
                order = np.lexsort((grams, count, doc))
                place = np.arange(len(order)) - upto[doc] + (total - own)[doc]  # texts stay in their order
                n = total[doc].astype(np.float64)
                most = (n - place) / alpha - n  # k-mers of the largest partner
                longest = np.minimum(n, most) + 1e-6
                first = np.floor(np.log(np.maximum(at_least * n - 1e-6, 0.5)) / STEP).astype(np.int64)
                last = np.floor(np.log(np.maximum(longest, 0.5)) / STEP).astype(np.int64)
                asks = np.flatnonzero(longest >= at_least * n - 1e-6)
                steps = (last - first + 1)[asks]
                probe = np.repeat(asks, steps)
                probe_step = first[probe] + np.arange(len(probe)) - np.repeat(np.cumsum(steps) - steps, steps)
                held = np.flatnonzero(most >= n - 1e-6)
                at = np.concatenate([held, probe])
                step = np.concatenate([np.floor(np.log(n[held] + 1e-6) / STEP).astype(np.int64), probe_step])
                key = mix(grams[order][at] + step.astype(np.uint64) * np.uint64(BASES[1]))
                rows = pa.array(doc[at] + lo)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.arange(len(at)) < len(held)), *(batch.column(c).take(rows) for c in (1, 0, 2))], names=["key", "indexed", "label", "fp", "n"])
                lo = hi

    return texts.select("fp", "label", "n", "shared").mapInArrow(run, "key long, indexed boolean, label binary, fp binary, n long")


def near_groups(crowd: DataFrame, k: int, at_least: float) -> DataFrame:
    """crowd (fp, label, text) to (key, indexed, label, fp, n): rows of prefix_rows whose key several labels and both kinds of rows share. Written."""
    rows = written(prefix_rows(shared_kmers(crowd, k, at_least), at_least))
    keys = rows.groupBy("key").agg(F.min("label").alias("one"), F.max("label").alias("other"), F.bool_or("indexed").alias("held"), F.bool_or(~F.col("indexed")).alias("asked"))
    mixed = written(keys.where("one <> other and held and asked").select("key"))
    return written(rows.join(mixed.hint("merge"), "key"))


def same_texts() -> list[Column]:
    """What tells sets of texts apart: 128 bits, the count, and two of the texts. Of groups with the same texts one is enough."""
    return [F.min("fp").alias("first"), F.max("fp").alias("last"), F.count("*").alias("c"), F.bit_xor(F.xxhash64("fp")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "fp")).alias("y")]


def open_groups(groups: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """groups (key, fp, n) that hold several labels, one of those with the same texts, with label, and a text of each group as hub and hub_label. Written."""
    named = groups.join(labels, F.col("fp") == F.col("node"), "left").select("key", "fp", "n", F.coalesce("label", "fp").alias("label"))
    by = F.struct(F.xxhash64("fp", F.lit(turn)).alias("h"), F.col("fp").alias("hub"), F.col("label").alias("hub_label"))
    several = named.groupBy("key").agg(*same_texts(), F.min("label").alias("one"), F.max("label").alias("other"), F.min(by).alias("m")).where("one <> other")
    kept = several.groupBy("first", "last", "c", "x", "y").agg(F.min(F.struct("key", "m")).alias("k")).select("k.key", "k.m.hub", "k.m.hub_label")
    return written(named.join(written(kept), "key"))


def cells(groups: DataFrame, block: int) -> DataFrame:
    """(block, role, label, fp) for verified: in each key's group (key, label, fp, n) with several labels, texts outside the largest label against all, block by block."""
    per_label = groups.groupBy("key", "label").agg(F.count("*").alias("c"), F.max("n").alias("n"))
    mixed = per_label.groupBy("key").agg(F.max_by("label", F.struct("c", "label")).alias("most"), F.sum("c").alias("all"), F.max("c").alias("top"), F.max("n").alias("n"), F.count("*").alias("labels")).where("labels > 1")
    parts = lambda c: F.ceil(c / block_rows(block, F.col("n"))).cast("int")
    mixed = written(mixed.select("key", "most", parts(F.col("all")).alias("cols"), parts(F.col("all") - F.col("top")).alias("rows")))
    cross = groups.select("key", "label", "fp").join(mixed, "key").withColumn("h", F.xxhash64("fp"))
    row, col = F.pmod("h", "rows"), F.pmod(F.shiftright("h", 32), "cols")
    asks = cross.where("label != most").select(F.lit(0).alias("role"), "label", "fp", "key", row.alias("r"), F.explode(F.sequence(F.lit(0), F.col("cols") - 1)).alias("c"))
    told = cross.select(F.lit(1).alias("role"), "label", "fp", "key", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("r"), col.alias("c"))
    name = F.concat_ws(":", F.col("key").cast("string"), F.col("r").cast("string"), F.col("c").cast("string")).cast("binary")
    return asks.unionByName(told).select(name.alias("block"), "role", "label", "fp")


def text_classes(base: DataFrame, k: int = 5, at_least: float = 0.8, sketches: int = 32, picks: int = 4, block: int = 256, rounds: int = 2) -> DataFrame:
    """base (doc_id, text, fp) to (fp, class_id, names): each text with words, its class, and whether it is the one the class is named by."""
    # Joins that grow with the corpus are sorted merges at every size, so that a small run shows what a large one does.
    with scratch(base.sparkSession) as keep:
        wordy = base.where(F.col("text").rlike(WORDY))
        reps = wordy.groupBy("fp").agg(F.min("doc_id").alias("rep"))
        sigs = written(sketch_table(wordy, k, sketches, picks))
        several = sigs.groupBy("sig").agg(F.count("*").alias("c")).where("c > 1").select("sig").hint("merge")
        parted = written(by_size(sigs.join(several, "sig").distinct(), at_least))
        buckets = parted.groupBy("bucket").agg(*same_texts()).where("first <> last").groupBy("first", "last", "c", "x", "y").agg(F.min("bucket").alias("bucket"))
        members = written(parted.join(buckets.select("bucket", "c"), "bucket"))
        # The hub is the text that meets most others in its buckets: of many copies one that few changes part from the rest.
        known = members.join(members.groupBy("fp").agg(F.sum("c").alias("met")), "fp")
        hubs = known.groupBy("bucket").agg(F.max_by("fp", F.struct("met", "fp")).alias("hub"))
        pairs = written(members.join(hubs, "bucket").where("fp != hub").select("fp", "n", "hub").distinct())
        involved = written(pairs.select("fp").union(pairs.select("hub")).distinct().join(reps, "fp"))
        i = involved.select(F.col("fp").alias("ifp"), "rep").hint("merge")
        texts = written(wordy.join(i, (F.col("fp") == F.col("ifp")) & F.col("doc_id").eqNullSafe(F.col("rep"))).select("fp", "text"))

        whole = texts.hint("merge")
        labels = components(written(verified(hub_blocks(pairs, block).join(whole, "fp"), k, at_least)))
        named = members.join(labels, F.col("fp") == F.col("node"), "left").select("bucket", "fp", F.coalesce("label", "fp").alias("label"))
        mixed = named.groupBy("bucket").agg(F.min("label").alias("one"), F.max("label").alias("other")).where("one <> other").select("bucket")
        crowd = named.join(mixed, "bucket").select("fp", "label").distinct()
        # Texts of buckets that still hold several classes are compared where they share a rare k-mer, as any two of the
        # similarity do: in each such group with one of its texts, which then leaves, and after some rounds across.
        near = near_groups(written(crowd.join(whole.dropDuplicates(["fp"]), "fp")), k, at_least)
        groups = near.select("key", "fp", "n").distinct()
        for turn in range(rounds):
            live = open_groups(groups, labels, turn)
            pairs = written(live.where("label <> hub_label").select("fp", "n", "hub").distinct())
            labels = joined(labels, written(verified(hub_blocks(pairs, block).join(whole, "fp"), k, at_least)))
            groups = live.where("fp <> hub").select("key", "fp", "n")
        left = open_groups(groups, labels, rounds)
        ks = left.groupBy("fp").agg(F.array_sort(F.collect_list("key")).alias("ks"))
        labels = joined(labels, written(verified(written(cells(left, block)).join(whole.join(ks, "fp"), "fp"), k, at_least)))

        classes = written(reps.join(labels, F.col("fp") == F.col("node"), "left").select("fp", "rep", F.coalesce("label", "fp").alias("label")))
        first = F.struct(F.col("rep").isNull(), F.col("rep"), F.col("fp"))
        named = written(classes.groupBy("label").agg(F.min(first).alias("m")))
        return keep(classes.join(named, "label").select("fp", F.col("m.rep").alias("class_id"), (F.col("fp") == F.col("m.fp")).alias("names")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(doc_id, class_id), one row per input row: the class's smallest doc_id.

    Exact copies and texts linked by a chain of similarities share a class. A
    text without words (null and empty ones too) is alone: its class is its own
    id. A null id belongs to its text's class and is never its name unless all
    ids are null. `how` is for text_classes.
    """
    base = text_key(doc_view(docs, id_col, text_col))
    rows = base.select("doc_id", F.when(F.col("text").rlike(WORDY), F.col("fp")).alias("fp"))
    return rows.join(text_classes(base, **how), "fp", "left").select("doc_id", F.when(F.col("fp").isNotNull(), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of docs that name their class, one each, as they are; rows without words all stay."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    base = text_key(docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("text"), F.struct(*[docs[c] for c in docs.columns]).alias("row")))
    of = text_classes(base.select("doc_id", "text", "fp"), **how)
    wordy = F.col("text").rlike(WORDY)
    rows = base.where(wordy).select("doc_id", "fp", "row")
    kept = rows.join(of.where("names").select(F.col("fp").alias("k"), "class_id"), (F.col("fp") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("class_id")), "left_semi")
    same = rows.groupBy("fp", "doc_id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
    if same:  # rows that agree in id and text: one of them stays
        kept = kept.dropDuplicates(["fp"])
    return kept.select("row.*").unionByName(base.where(~wordy).select("row.*"))
