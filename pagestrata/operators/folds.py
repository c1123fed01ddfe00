"""Order-dependent selections that no window can express.

Each is F.aggregate over a document's candidates, sorted in one array: the
state is a small struct, the step a plain expression, so the whole fold stays
in the JVM. Candidates of a document are few (a document has some hundred
pages); documents are spread over tasks by the groupBy.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(df: DataFrame, part: Sequence[str], order: Sequence[str], columns: Sequence[str], state: dict[str, Column], step: Callable[[Column, Column], dict[str, Column]], emit: Callable[[Column, Column], Column] | None = None, keep: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """Goes over each partition's rows in order. step(state, row) gives the next state; rows for which keep(state, row) holds (all without it) come out, with emit(state after, row) as `state` if given."""
    names = list(dict.fromkeys([*order, *columns]))
    row_type = F.struct(*names)
    rows = F.array_sort(F.collect_list(row_type)).alias("_rows")
    grouped = df.groupBy(*part).agg(rows)
    out_kind = F.filter(F.transform("_rows", lambda r: F.struct(r.alias("row"), _state(state).alias("state"))), lambda r: F.lit(False))

    def go(acc, row):
        nxt = step(acc["state"], row)
        after = F.struct(*[nxt.get(k, acc["state"][k]).cast(_kinds[k]).alias(k) for k in state])
        one = F.array(F.struct(row.alias("row"), after.alias("state")))
        out = F.concat(acc["out"], one) if keep is None else F.when(keep(acc["state"], row), F.concat(acc["out"], one)).otherwise(acc["out"])
        return F.struct(after.alias("state"), out.alias("out"))

    _kinds = dict(df.sparkSession.range(1).select(_state(state).alias("s")).select("s.*").dtypes)
    start = F.struct(_state(state).alias("state"), out_kind.alias("out"))
    folded = grouped.select(*part, F.explode(F.aggregate("_rows", start, go, lambda a: a["out"])).alias("_o"))
    return folded.select(*part, *[F.col("_o.row")[n].alias(n) for n in names if n not in part], F.col("_o.state").alias("state"))


def _state(state: dict[str, Column]) -> Column:
    return F.struct(*[v.alias(k) for k, v in state.items()])


def amended(row: Column, kinds: dict[str, str], **new: Column) -> Column:
    """row (a struct of the columns in kinds) with some of its fields new."""
    return F.struct(*[new.get(n, row[n]).cast(kind).alias(n) for n, kind in kinds.items()])


def kept_rows(df: DataFrame, part: Sequence[str], order: Sequence[str], step: Callable[[Column, Column, Column, Column], tuple[Column, dict[str, Column]]], state: dict[str, Column] | None = None) -> DataFrame:
    """A fold that holds the rows it has kept, open to change, and emits them when the partition ends.

    step(kept, row, next, state) gives the new list of kept rows, an array of
    structs of df's columns, and the parts of the state that change; next is null
    for the last row. `kinds` of amended() are kinds_of(df). A partition's rows are
    few (a document's topics): each step writes the list anew.
    """
    kinds = kinds_of(df)
    names = list(dict.fromkeys([*order, *kinds]))
    start = {"_": F.lit(0), **(state or {})}
    of = dict(df.sparkSession.range(1).select(_state(start).alias("s")).select("s.*").dtypes)
    rows = df.groupBy(*part).agg(F.array_sort(F.collect_list(F.struct(*names))).alias("_r"))
    plain = F.transform("_r", lambda r: amended(r, kinds))
    ahead = F.transform(plain, lambda r, i: F.struct(r.alias("row"), F.get(plain, i + 1).alias("next")))

    def go(acc, x):
        kept, new = step(acc["kept"], x["row"], x["next"], acc["st"])
        return F.struct(kept.alias("kept"), F.struct(*[new.get(k, acc["st"][k]).cast(of[k]).alias(k) for k in start]).alias("st"))

    nothing = F.struct(F.filter(plain, lambda r: F.lit(False)).alias("kept"), _state(start).alias("st"))
    return rows.select(F.explode(F.aggregate(ahead, nothing, go, lambda a: a["kept"])).alias("_k")).select("_k.*")


def kinds_of(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


def last_of(kept: Column) -> Column:
    """The row kept last; null without any."""
    return F.try_element_at(kept, F.lit(-1))


def with_last(kept: Column, row: Column) -> Column:
    """kept with another row instead of its last one."""
    return F.concat(F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0))), F.array(row))


def greedy_covers(df: DataFrame, part: Sequence[str], page: str, apart: int, columns: Sequence[str] = (), fill: str | None = None) -> DataFrame:
    """A page is kept if it is more than `apart` pages after the last kept one. fill: a column of which a kept page takes the first value, its own or else one of the pages that are dropped after it."""
    far = lambda s, r: s["kept"].isNull() | (r[page] - s["kept"] > apart)
    state, step = {"kept": F.lit(None).cast("long")}, lambda s, r: {"kept": F.when(far(s, r), r[page]).otherwise(s["kept"])}
    if fill is None:
        return fold(df, part, [page], columns, state, step, keep=far)
    every = fold(df, part, [page], [*columns, fill], state, step)
    value = F.min_by(fill, F.when(F.col(fill).isNotNull(), F.col(page))).alias(fill)
    own = [F.min_by(c, F.col(page)).alias(c) for c in columns]
    return every.groupBy(*part, F.col("state.kept").alias("_kept")).agg(F.min(page).alias(page), *own, value).drop("_kept")


def promote_rising(df: DataFrame, part: Sequence[str], order: Sequence[str], number: str, step: int = 3, restart_after: int = 5) -> DataFrame:
    """Numbers that rise by `step` at most, or start at 1 again once `restart_after` was reached."""
    ok = lambda s, r: ((r[number] > s["last"]) & (r[number] - s["last"] <= step)) | ((r[number] == 1) & (s["last"] >= restart_after))
    return fold(df, part, order, [number], {"last": F.lit(0).cast("long")}, lambda s, r: {"last": F.when(ok(s, r), r[number].cast("long")).otherwise(s["last"])}, keep=ok)
