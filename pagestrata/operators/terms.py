"""Which terms of a dictionary a text holds, in one pass over the texts.

An Aho-Corasick automaton takes the place of a nested-loop join of texts and
terms: the cost is the texts' length, not texts times terms. The automaton is
made once in a worker process from a block of the dictionary that is bounded in
bytes; a larger dictionary is looked for block by block.
"""

from __future__ import annotations

import uuid
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.stages import staged

#: Bytes of terms in one automaton.
BLOCK_BYTES = 8 << 20

#: The automaton of this worker process: only the last one asked for is held.
_BUILT: dict[str, object] = {}


def _automaton(key: str, terms: list[str]):
    if key not in _BUILT:
        import ahocorasick

        auto = ahocorasick.Automaton()
        for t in terms:
            auto.add_word(t, t)
        auto.make_automaton()
        _BUILT.clear()
        _BUILT[key] = auto
    return _BUILT[key]


def term_hits(rows: DataFrame, key: str, texts: dict[str, Column], terms: DataFrame, term: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each row of `rows` and each distinct term that one of its texts holds: key, term, and a flag by name of `texts`.

    A dictionary of several blocks is looked for block by block, each with a pass of its own over the texts, and written.
    Null texts hold nothing; null and empty terms are in no text.
    """
    kind = rows.schema[key].dataType
    every = terms.select(F.col(term).alias("t")).where(F.length("t") > 0).distinct()
    size = every.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    names = list(texts)
    source = rows.select(F.col(key), *[c.alias(n) for n, c in texts.items()])
    schema = f"{key} {kind.simpleString()}, {term} string, " + ", ".join(f"{n} boolean" for n in names)

    def found(block: int) -> DataFrame:
        words = [r["t"] for r in every.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == block).collect()]  # at most about block_bytes
        if not words:
            return source.sparkSession.createDataFrame([], schema)
        name, shared = uuid.uuid4().hex, rows.sparkSession.sparkContext.broadcast(words)

        def run(batches):
            auto = _automaton(name, shared.value)
            for batch in batches:
                at, hits, flags = [], [], [[] for _ in names]
                for k in range(batch.num_rows):
                    held = [{t for _, t in auto.iter(x)} if (x := batch.column(c + 1)[k].as_py()) else set() for c in range(len(names))]
                    for t in set().union(*held):
                        at.append(k)
                        hits.append(t)
                        for flag, own in zip(flags, held):
                            flag.append(t in own)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(hits, pa.string()), *(pa.array(f, pa.bool_()) for f in flags)], names=[key, term, *names])

        return source.mapInArrow(run, schema)

    if blocks == 1:
        return found(0)
    return reduce(DataFrame.unionByName, [staged(found(k)) for k in range(blocks)])  # one block of terms at a time on driver and executors
