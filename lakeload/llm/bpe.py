"""Byte-level BPE by a lazily determinised transducer, and streaming decoding.

A sequence of tokens is the BPE encoding of its bytes exactly when each token encodes as itself and each adjacent
pair encodes as that pair.  So reading a pre-token byte by byte, the last token of every prefix is unique, and the
open hypotheses are the positions at which a longer token may still have begun.  Tokens that all hypotheses share are
emitted; what remains (the last emitted token and the bytes after it) is the state.  Transitions are computed when
first needed and kept in a table of bounded size.

Decoding feeds ids to an incremental UTF-8 state machine whose states are the bytes of an incomplete character.

Edge cases: a NULL or empty text has no tokens and decodes to no bytes; repeated rows are encoded one by one; an empty
table gives no rows; long texts are encoded pre-token by pre-token in a loop; incomplete or wrong UTF-8 in ids decodes
to U+FFFD.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import per_process

# Entries of a worker process's tables (some 90 and 20 MB when full): transitions (and half as many pairs of tokens) and
# pre-tokens in each of two generations.  A full table of transitions stays, others are computed as they come, until
# these are REFRESH times as many: then the table is begun anew.
TABLE_SIZE = 300_000
KEPT_PIECES = 50_000
REFRESH = 4
# Pre-tokens of up to this many bytes are kept with their encoding.
KEPT_BYTES = 64
NEVER = 1 << 60


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Transducer:
    """The transducer of one vocabulary; ``encode`` gives the ids of a pre-token's bytes.

    A state is a number; its content is the last emitted token (-1: none, or no longer needed) and, for each position at
    which a later token may begin, the node of the tokens' trie that the bytes from there lead to and the tokens up to
    there, the longest bytes first, in one flat tuple.  Transitions of all states are in one table of plain numbers, of
    (state, tokens) where tokens are emitted."""

    def __init__(self, ranks: dict[bytes, int], table_size: int = TABLE_SIZE):
        self.ranks, self.size = ranks, table_size
        self.bytes_of = {i: b for b, i in ranks.items()}
        # the trie: the node that a byte leads to, the token that ends at a node (-1: none), whether longer ones begin so
        self.child: dict[int, int] = {}
        self.token = array("i", [-1])
        for data, rank in ranks.items():
            node = 0
            for b in data:
                key = node << 8 | b
                node = self.child.get(key, 0)
                if not node:
                    node = self.child[key] = len(self.token)
                    self.token.append(-1)
            self.token[node] = rank
        self.inner = bytearray(len(self.token))
        for key in self.child:
            self.inner[key >> 8] = 1
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.edges: tuple[dict, dict] = ({}, {})
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.content: list[tuple] = []
        self.moves: dict[int, int | tuple[int, tuple]] = {}
        self.pairs: dict[int, bool] = {}
        self.missed = 0
        self.state((-1, 0, ()))

    def state(self, content: tuple) -> int:
        found = self.numbers.get(content)
        if found is None:
            found = self.numbers[content] = len(self.content)
            self.content.append(content)
        return found

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge gives ``token``; (token, token) for a byte, None when merging gives others."""
        found = self.halves.get(token, 0)
        if found == 0:
            data, ranks = self.bytes_of[token], self.ranks
            parts = [data[i:i + 1] for i in range(len(data))]
            while len(parts) > 2:
                rank, at = min((ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
                if rank == NEVER:
                    break
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            found = (token, token) if len(parts) == 1 else tuple(ranks[p] for p in parts) if len(parts) == 2 else None
            self.halves[token] = found
        return found

    def edge(self, token: int, side: int) -> tuple[list[bytes], list[int]] | None:
        """The tokens at the right (1) or left (0) end of ``token`` while it is merged, from the byte up: their bytes,
        and the rank of the merge that ends each."""
        kept = self.edges[side]
        found = kept.get(token, 0)
        if found == 0:
            out = [token]
            while out[-1] is not None and (halves := self.split(out[-1])) != (out[-1], out[-1]):
                out.append(halves[side] if halves else None)
            found = None if out[-1] is None else ([self.bytes_of[t] for t in out[::-1]], [*out[-2::-1], NEVER])
            kept[token] = found
        return found

    def fits(self, a: int, b: int) -> bool:
        """Whether merging the bytes of ``a`` (-1: none) and ``b`` leaves these two tokens: no merge across the border may
        come before the next merge at either end (of equal ranks the leftmost merge comes first)."""
        if a < 0:
            return self.edge(b, 0) is not None
        ok = self.pairs.get(a << 32 | b)
        if ok is None:
            left, right, rank = self.edge(a, 1), self.edge(b, 0), self.ranks.get
            i = j = 0
            ok = left is not None and right is not None
            while ok:
                next_a, next_b = left[1][i], right[1][j]
                across = rank(left[0][i] + right[0][j], NEVER)
                if across < next_a and across <= next_b and across < NEVER:
                    ok = False
                elif next_a <= next_b:
                    if next_a == NEVER:
                        break
                    i += 1
                else:
                    j += 1
            if 2 * len(self.pairs) < self.size:
                self.pairs[a << 32 | b] = ok
        return ok

    def after(self, content: tuple, byte: int) -> tuple[tuple, tuple]:
        """The content of the state that ``byte`` leads to from one of ``content``, and the tokens emitted."""
        before, *alive = content
        child, last, after = self.child, None, []
        for i in range(0, len(alive), 2):  # the longest bytes first
            node, chain = child.get(alive[i] << 8 | byte), alive[i + 1]
            if node is None:
                continue
            t = self.token[node]
            if last is None and t >= 0:
                previous = chain[-1] if chain else before
                ok = self.pairs.get(previous << 32 | t) if previous >= 0 else None
                if self.fits(previous, t) if ok is None else ok:
                    last = (*chain, t)
            if self.inner[node]:
                after += (node, chain)
        if last is not None:
            after += (0, last)
        shared = ()
        if after and after[1]:
            shared = after[1]
            for c in after[3::2]:
                k = 0
                while k < len(shared) and k < len(c) and shared[k] == c[k]:
                    k += 1
                shared = shared[:k]
            if shared:
                k, before = len(shared), shared[-1]
                after[1::2] = [c[k:] for c in after[1::2]]
        if after and after[1]:
            before = -1  # the token after it is decided for all
        return (before, *after), shared

    def move(self, state: int, byte: int) -> int | tuple[int, tuple]:
        content, shared = self.after(self.content[state], byte)
        number = self.state(content)
        result = self.moves[state << 8 | byte] = (number, shared) if shared else number
        return result

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if self.missed > REFRESH * self.size:
            self.forget()
        state, out, known = 0, [], self.moves.get
        content = None  # of a state that the full table does not hold
        for byte in piece:
            if content is None:
                step = known(state << 8 | byte)
                if step is None and len(self.moves) < self.size:
                    step = self.move(state, byte)
                if step.__class__ is int:
                    state = step
                    continue
                if step is not None:
                    state, emitted = step
                    out += emitted
                    continue
                content = self.content[state]
            content, emitted = self.after(content, byte)
            out += emitted
            self.missed += 1
        content = self.content[state] if content is None else content
        if len(content) == 1 or content[-2]:
            raise ValueError("the vocabulary's merges are not those of a byte-level BPE")
        out += content[-1]
        return out


class Encoder:
    """Texts to ids: the pattern splits a text, each pre-token goes through the transducer.  Pre-tokens are kept in two
    generations: the older one goes when the newer one is full, and what is still in use moves up."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, table_size: int = TABLE_SIZE, kept: int = KEPT_PIECES):
        self.transducer, self.split, self.size = Transducer(ranks, table_size), regex.compile(pattern), kept
        self.kept: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def piece(self, piece: str) -> tuple[int, ...]:
        """The ids of a pre-token that isn't in the newer generation."""
        ids = self.older.get(piece)
        if ids is None:
            data = piece.encode()
            ids = tuple(self.transducer.encode(data))
            if len(data) > KEPT_BYTES:
                return ids
        if len(self.kept) >= self.size:
            self.older, self.kept = self.kept, {}
        self.kept[piece] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        if len(text) > 1 << 20:
            for m in self.split.finditer(text):
                out += self.kept.get(m.group()) or self.piece(m.group())
            return out
        found = self.split.findall(text)
        for piece, ids in zip(found, map(self.kept.get, found)):
            out += ids or self.piece(piece)
        return out


def complete(data: bytes) -> int:
    """How many bytes of ``data`` come before a character that is still incomplete."""
    for back in range(1, min(3, len(data)) + 1):
        b = data[-back]
        if b >= 0xC0:
            need = 2 if b < 0xE0 else 3 if b < 0xF0 else 4
            return len(data) - back if need > back else len(data)
        if b < 0x80:
            break
    return len(data)


class Decoder:
    """Ids to text as they come: a state machine whose state is the bytes of the character that is still incomplete.
    A step takes the bytes of some ids, gives the characters that they complete and the next state."""

    def __init__(self, bytes_of: dict[int, bytes], chunk: int = 4096):
        self.bytes_of, self.chunk = bytes_of, chunk

    def step(self, state: bytes, ids: Iterable[int]) -> tuple[str, bytes]:
        data = state + b"".join(map(self.bytes_of.__getitem__, ids))
        cut = complete(data)
        return data[:cut].decode("utf-8", "replace"), data[cut:]

    def stream(self, ids: Iterable[int]) -> Iterator[str]:
        state, rest = b"", iter(ids)
        while part := list(islice(rest, self.chunk)):
            text, state = self.step(state, part)
            yield text
        if state:
            yield state.decode("utf-8", "replace")

    def decode(self, ids: Iterable[int]) -> str:
        return "".join(self.stream(ids))


def vocabulary() -> tuple[str, str]:
    """The production vocabulary's file and the pattern that splits texts."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


# What encode_docs can return, with the types of Spark and Arrow.
OUTPUTS = {"n_tokens": ("long", pa.int64()), "ids": ("array<int>", pa.list_(pa.int32())), "decoded": ("string", pa.string()),
           "ids_sha256": ("string", pa.string()), "decoded_sha256": ("string", pa.string())}


def encode_docs(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text",
                outputs: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """doc_id and ``outputs`` (see OUTPUTS) per row: ids, the text decoded from them, their number, SHA-256 of the
    decimal ids joined by commas and of the decoded bytes.  Rows keep their partitions; nothing is shuffled.  The
    vocabulary file must be readable at ``path`` on the executors (installed there, as the library that ships it is)."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_process(("bpe", path, pattern), lambda: Encoder(load_ranks(path), pattern))
        decoder = Decoder(encoder.transducer.bytes_of)
        digits = {i: str(i) for i in encoder.transducer.bytes_of}.__getitem__
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        make = {"n_tokens": lambda ids, back: len(ids), "ids": lambda ids, back: ids, "decoded": lambda ids, back: back,
                "ids_sha256": lambda ids, back: sha(",".join(map(digits, ids))), "decoded_sha256": lambda ids, back: sha(back)}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, rows = batch.slice(at, 256), []
                for value in part.column(1):
                    ids = encoder.encode(value.as_py() or "")
                    back = decoder.decode(ids)
                    rows.append([make[o](ids, back) for o in outputs])
                cols = [pa.array([r[i] for r in rows], OUTPUTS[o][1]) for i, o in enumerate(outputs)]
                yield pa.RecordBatch.from_arrays([part.column(0), *cols], ["doc_id", *outputs])
            pa.default_memory_pool().release_unused()

    schema = ", ".join([f"doc_id {kind}", *(f"{o} {OUTPUTS[o][0]}" for o in outputs)])
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)
