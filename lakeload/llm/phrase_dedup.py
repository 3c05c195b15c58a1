"""Substring deduplication with repeated-phrase automata.

Recurring passages are confirmed by counting (see ``repeats``): the contexts of anchored windows of 20 words that
occur more than once, and those that share windows with another context.  Documents are dealt into shards; the
passages confirmed in a shard's documents are compiled into one Aho-Corasick automaton over word numbers, and
all documents of the shard stream through it, which locates every occurrence.  An occurrence after the passage's
first one in the corpus loses all its words; the first one loses the windows that start earlier in other passages.

Edge cases: a NULL or empty text has no words; texts of fewer words than a window lose nothing; rows with a NULL id
count as one document after all others; of rows that share an id, equal windows at the same place are no earlier than
each other, so equal rows of one id keep the same words; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import compress, count

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import dropped, stored
from lakeload.llm.repeats import Units, compared, keyed, repeated_rows

WINDOW = 20
CORE = 6
# Words and rows of a shard, whichever comes first; bounds an automaton's size.  An automaton's root searches its
# children one by one, so many small automata are faster than a few large ones.
SHARD_WORDS = 24_000
SHARD_ROWS = 64
FIELDS = ["s", "n", "first_id", "first_s", "ranges"]


def passages(docs: DataFrame, window: int = WINDOW, core: int = CORE) -> tuple[DataFrame, DataFrame]:
    """(keyed documents, passages): per document that has confirmed passages arrays (s, n, first_id, first_s, ranges)
    of them: n windows from word s on, where its first occurrence is, and which windows that one loses."""
    units = Units(words=True, window=window, core=core)
    k = keyed(docs, "doc_id", "text")
    again, contexts, paths = repeated_rows(k, units)
    ranges = compared(k, contexts, units, earlier=True).groupBy("core", "ctx").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    side = contexts.select("core", "ctx", F.col("n").alias("copies"), F.col("oid").alias("first_id"), F.col("s").alias("first_s"))
    side = side.join(ranges, ["core", "ctx"], "left").where((F.col("copies") > 1) | F.col("ranges").isNotNull())
    side, path = stored(side, "passages")  # a kept side lets AQE split the rows of a passage with very many copies
    found = again.select("core", "ctx", "rkey", "pos").join(side, ["core", "ctx"])
    found = found.select("rkey", F.shiftright("pos", 12).alias("s"), F.col("pos").bitwiseAND(F.lit(4095)).alias("n"), "first_id",
                         "first_s", "ranges")
    # a set: equal rows have one row key and the same passages, which partial sets keep once
    lists, _ = stored(found.groupBy("rkey").agg(F.collect_set(F.struct(*FIELDS)).alias("x")), "occurrences")
    for done in (*paths, path):
        dropped(docs.sparkSession, done)
    return k, lists.select("rkey", *[F.col(f"x.{c}").alias(c) for c in FIELDS])


class Shard:
    """An automaton of the passages confirmed in some documents, and the documents."""

    def __init__(self, window: int):
        self.window, self.numbers, self.docs, self.words = window, defaultdict(count().__next__), [], 0
        self.phrases: dict[tuple, tuple] = {}

    def add(self, row: tuple, oid: int, text: bytes, found: list[tuple]) -> None:
        words = text.split()
        ids = tuple(map(self.numbers.__getitem__, words))
        self.docs.append((row, oid, words, ids))
        self.words += len(words)
        for s, n, first_id, first_s, ranges in found:
            phrase = ids[s:s + n - 1 + self.window]
            had = self.phrases.get(phrase)
            if had is None or ranges:
                self.phrases[phrase] = (len(phrase), (first_id, first_s), ranges)

    def removed(self) -> Iterator[tuple[tuple, list[bytes], np.ndarray]]:
        """(row, words, mask of the words to remove) of each document."""
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for phrase, value in self.phrases.items():
            automaton.add_word(phrase, value)
        if self.phrases:
            automaton.make_automaton()
        for row, oid, words, ids in self.docs:
            steps = np.zeros(len(words) + 1, np.int64)
            for end, (length, first, ranges) in automaton.iter(ids) if self.phrases and len(ids) >= self.window else ():
                begin = end + 1 - length
                here = (oid, begin)
                if first < here:
                    steps[begin] += 1
                    steps[end + 1] -= 1
                elif first == here:
                    for r in ranges or ():
                        steps[begin + r["a"]] += 1
                        steps[begin + r["b"] - 1 + self.window] -= 1
            yield row, words, np.cumsum(steps[:-1]) > 0


def deduplicate(docs: DataFrame, window: int = WINDOW, core: int = CORE, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept (text) per row of ``docs`` (doc_id, text); with ``digest`` kept_sha256."""
    k, found = passages(docs.select("doc_id", "text"), window, core)
    joined = k.join(found, "rkey", "left").select("doc_id", "oid", "text", *FIELDS)
    kind = docs.schema["doc_id"].dataType
    last = "kept_sha256" if digest else "kept"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(shard: Shard, ids: pa.DataType) -> pa.RecordBatch:
            rows = []
            for row, words, gone in shard.removed():
                kept = list(compress(words, (~gone).tolist())) if gone.any() else words
                body = b" ".join(kept)
                rows.append((row, len(words), len(words) - len(kept), hashlib.sha256(body).hexdigest() if digest else body.decode()))
            cols = [pa.array([r[i] for r in rows], t) for i, t in enumerate([ids, pa.int64(), pa.int64(), pa.string()])]
            return pa.RecordBatch.from_arrays(cols, ["doc_id", "n_words", "n_removed", last])

        for batch in batches:
            shard = Shard(window)
            ids = batch.schema.types[0]
            names, oids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())
            lists = [batch.column(3 + j) for j in range(len(FIELDS))]
            many = np.where(lists[0].is_valid().to_numpy(zero_copy_only=False), lists[0].value_lengths().fill_null(0).to_numpy(), 0).tolist()
            found, at = list(zip(*(c.flatten().to_pylist() for c in lists))), 0
            for i, n in enumerate(many):
                shard.add(names[i], oids[i], texts[i].as_py(), found[at:at + n])
                at += n
                if shard.words >= SHARD_WORDS or len(shard.docs) >= SHARD_ROWS:
                    yield done(shard, ids)
                    shard = Shard(window)
            if shard.docs:
                yield done(shard, ids)

    return joined.mapInArrow(run, f"doc_id {kind.simpleString()}, n_words long, n_removed long, {last} string")
