"""Token counts under a unigram vocabulary without making the tokens.

An Aho-Corasick automaton enumerates the vocabulary's pieces at each end position, longest first; dynamic programming
keeps the best score and its piece count per position.  Tie rules are those of the public Unigram tokenizers: a
candidate replaces another only with a strictly higher score, earlier starts (longer pieces) come first, and a
character that no piece covers costs the lowest score less 10 and counts as its UTF-8 bytes (byte fallback).  No
piece has the space mark after another character, so a text splits before each run of marks and each split
part is solved once per task and kept.

Edge cases: a NULL or empty text has 0 tokens; an empty table gives no rows; repeated rows are counted one by one; long
texts are split in a loop with bounded tables; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import per_process

MARK = "▁"
UNKNOWN_PENALTY = 10.0
TABLE_SIZE = 300_000
KEPT_CHARS = 64


def load_pieces(path: str) -> list[tuple[str, float]]:
    """The ordinary pieces and scores of a sentencepiece model file."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = (i for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i)))
    return [(m.id_to_piece(i), float(m.get_score(i))) for i in plain]


class Counter(dict):
    """(count, score) by part of a text; parts are solved when first asked for."""

    def __init__(self, pieces: list[tuple[str, float]], table_size: int = TABLE_SIZE):
        super().__init__()
        self.size = table_size
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        # pieces with a mark inside would join the parts that texts are split into
        self.splits = not any(MARK in p.lstrip(MARK) for p, _ in pieces)
        self.parts = re.compile(f"{MARK}+[^{MARK}]*")

    def solve(self, part: str) -> tuple[int, float]:
        n = len(part)
        score, count = [None] * (n + 1), [0] * (n + 1)
        score[0] = 0.0
        ends = self.automaton.iter(part) if len(self.automaton) else iter(())
        match = next(ends, None)
        for end in range(1, n + 1):
            best, pieces, single = None, 0, False
            while match is not None and match[0] == end - 1:
                length, own = match[1]
                single = single or length == 1
                total = own + score[end - length]
                if best is None or total > best:
                    best, pieces = total, count[end - length] + 1
                match = next(ends, None)
            if not single:
                total = self.unknown + score[end - 1]
                if best is None or total > best:
                    best, pieces = total, count[end - 1] + len(part[end - 1].encode("utf-8", "replace"))
            score[end], count[end] = best, pieces
        return count[n], score[n]

    def __missing__(self, part: str) -> tuple[int, float]:
        found = self.solve(part)
        if len(part) <= KEPT_CHARS:
            if len(self) >= self.size:
                self.clear()
            self[part] = found
        return found

    def count(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        marked = MARK + text.replace(" ", MARK)
        if not self.splits:
            return self.solve(marked)
        n, s = 0, 0.0
        found = (m.group() for m in self.parts.finditer(marked)) if len(marked) > 1 << 20 else self.parts.findall(marked)
        for a, b in map(self.__getitem__, found):
            n += a
            s += b
        return n, s


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def count_tokens(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, best_score per row; no shuffle.  The file must be readable at ``path`` on the executors."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = per_process(("unigram", path), lambda: Counter(load_pieces(path)))
        for batch in batches:
            found = [counter.count(v.as_py() or "") for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())],
                ["doc_id", "n_tokens", "best_score"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, best_score double")
