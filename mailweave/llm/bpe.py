"""BPE encoding and decoding of whole texts with a public tokenizer file.

Long texts are encoded by tree concatenation. A text of more than ``TEXT`` characters is halved,
wherever that falls, until its parts are short enough; the parts are encoded apart and then
joined in a tree. What stands around a join is encoded again in a window that
grows on each side until its outermost piece is one of that side: beyond it both sides agree with
the whole text. For this a part is held in pieces, cut where the tokenizer's own splitting cannot
look across: at a single space between two characters that are no white space. Pieces are encoded
by the tokenizers library and remembered, as most of them come again.

A piece that stays long itself (text without spaces, such as a script that uses none, encoded data,
or one character ten thousand times) is encoded by a tree of tokens. Within each of the splitting
pattern's runs, halves are encoded apart, all of them in one parallel batch, and joined: the
tokens around a join are encoded again in a window that grows until its first token is a token of
the left side and its last one a token of the right side. Then every pair of neighbours in the
result is one that BPE itself leaves alone, which makes the result that of the whole run. Long
runs thus need neither one long merge nor a guess.

Edge cases: a null or empty text has no ids and decodes to the empty text. The text of a special
token becomes its id, as the library does. Repeated rows are encoded each. Extra columns are
kept; an existing column with the output's name is replaced. An empty table gives no rows.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from mailweave.llm.common import table

TOKENIZER = "byte_bpe_50k.json"
GAP = re.compile(r" (?=\S)(?<=\S )")
# Letters of the Latin blocks, then signs; all else is left to the library's own splitting.
WORD = re.compile(r"([A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([.,;:!?]*)")
SLICE_CHARS = 1 << 20
TEXT = 4096  # characters from which on a text is halved
REMEMBERED = 100_000  # pieces a worker keeps the ids of, twice over, some 40 MB


Side = tuple[list[str], list[bytes]]  # pieces in order, and their ids


def halves(text: str, most: int) -> list[str]:
    """The text halved until no part is longer than ``most``; parts of a level are alike long."""
    parts = [text]
    while len(parts[0]) > most:
        parts = [half for p in parts for half in (p[: (len(p) + 1) // 2], p[(len(p) + 1) // 2 :])]
    return parts


class Bpe:
    """Encoder and decoder."""

    def __init__(self, path: str, leaf: int = 256, long: int = 2048, remembered: int = REMEMBERED, halved: int = TEXT) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        # The merges alone, for runs that were split already.
        self.merges = Tokenizer(self.whole.model)
        self.leaf, self.long, self.remembered, self.halved = leaf, long, remembered, halved
        self.joined = self.joined_tokens = 0  # joins of halves of texts, and of runs
        vocabulary = self.whole.get_vocab(with_added_tokens=True)
        self.names = [""] * (max(vocabulary.values()) + 1)
        for name, i in vocabulary.items():
            self.names[i] = name
        self.special = {t.content: i for i, t in self.whole.get_added_tokens_decoder().items()}
        parts = [re.escape(t) for t in sorted(self.special, key=len, reverse=True)]
        self.special_pattern = re.compile("(" + "|".join(parts) + ")") if parts else None
        letters = _letter_bytes()
        self.bytes = [
            name.encode() if name in self.special else bytes(letters[c] for c in name) for name in self.names
        ]
        self.model = self.whole.model
        self.letter_of = {b: ord(c) for c, b in letters.items()}
        self.pieces = Pieces(self)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        self.pieces.renew()
        get = self.pieces.__getitem__
        out = []
        for text in texts:
            if len(text) > self.halved:
                ids = self.together([self.side(part) for part in halves(text, self.halved)])[1]
            else:
                first, *rest = GAP.split(text)
                ids = [self.piece(first), *map(get, rest)]
            out.append(b"".join(ids))
        return out

    def side(self, text: str) -> Side:
        """A part of a text by itself: its pieces and their ids."""
        first, *rest = pieces = GAP.split(text)
        return pieces, [self.piece(first), *map(self.pieces.__getitem__, rest)]

    def together(self, sides: list[Side]) -> Side:
        """The parts of a text joined in a tree."""
        while len(sides) > 1:
            pairs = [self.join_sides(a, b) for a, b in zip(sides[::2], sides[1::2])]
            sides = pairs + sides[len(pairs) * 2 :]
        return sides[0]

    def join_sides(self, left: Side, right: Side) -> Side:
        """Two parts as one: the window grows on each side that does not agree yet."""
        self.joined += 1
        (one, one_ids), (two, two_ids) = left, right
        a = b = 2
        while True:
            a, b = min(a, len(one)), min(b, len(two))
            again = GAP.split(" ".join(one[len(one) - a :]) + " ".join(two[:b]))
            left_agrees = a == len(one) or (len(again) > 1 and again[0] == one[-a])
            right_agrees = b == len(two) or (len(again) > 1 and again[-1] == two[b - 1])
            if left_agrees and right_agrees:
                break
            a, b = (a if left_agrees else 2 * a), (b if right_agrees else 2 * b)
        start = len(one) - a
        # Only the first piece of a text has no space before it.
        ids = [self.pieces[p] if start + k else self.piece(p) for k, p in enumerate(again)]
        one[start:], one_ids[start:] = again, ids
        one += two[b:]
        one_ids += two_ids[b:]
        return one, one_ids

    def piece(self, text: str) -> bytes:
        """Ids of a piece with the space before it, if it has one."""
        if len(text) > self.long:
            ids = self._long(text)
        else:
            ids = self.whole.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def word(self, text: str) -> bytes:
        """Ids of letters, with a space before or not, which the splitting pattern leaves whole."""
        spelled = text.encode().decode("latin-1").translate(self.letter_of)
        return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def _long(self, text: str) -> list[int]:
        """Ids of a long piece: the runs of the splitting pattern, each by its tree."""
        out: list[int] = []
        for part in self.special_pattern.split(text) if self.special_pattern else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                runs = [run for run, _ in self.whole.pre_tokenizer.pre_tokenize_str(part)]
                for ids in self.trees(runs):
                    out.extend(ids)
        return out

    def trees(self, runs: list[str]) -> list[list[int]]:
        """Ids of each run. The leaves of all runs are one batch, the joins of a level the next."""
        cut = [[r[i : i + self.leaf] for i in range(0, len(r), self.leaf)] for r in runs]
        # Only here does the library use more threads than the one a task has.
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        encoded = iter(self.merges.encode_batch_fast([leaf for leaves in cut for leaf in leaves]))
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        levels = [[next(encoded).ids for _ in leaves] for leaves in cut]
        for k, sides in enumerate(levels):
            while len(sides) > 1:
                pairs = [self.join(a, b) for a, b in zip(sides[::2], sides[1::2])]
                sides = pairs + sides[len(pairs) * 2 :]
            levels[k] = sides
        return [sides[0] if sides else [] for sides in levels]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Ids of the joined text: the window grows on each side that does not agree yet."""
        self.joined_tokens += 1
        a = b = 4
        while True:
            a, b = min(a, len(left)), min(b, len(right))
            head, tail = left[len(left) - a :], right[:b]
            again = self.merges.encode("".join(self.names[i] for i in [*head, *tail])).ids
            left_agrees = a == len(left) or again[0] == head[0]
            right_agrees = b == len(right) or again[-1] == tail[-1]
            if left_agrees and right_agrees:
                return [*left[: len(left) - a], *again, *right[b:]]
            a, b = (a if left_agrees else 2 * a), (b if right_agrees else 2 * b)

    def decode(self, ids: bytes) -> str:
        """As the library's decode with special tokens kept; broken UTF-8 is replaced."""
        numbers = np.frombuffer(ids, dtype="<u4").tolist()
        return b"".join(map(self.bytes.__getitem__, numbers)).decode("utf-8", "replace")


_ready: dict[tuple, Bpe] = {}


def ready(path: str, remembered: int = REMEMBERED) -> Bpe:
    """The worker's encoder: loaded once, and what it remembers serves its later tasks."""
    if (path, remembered) not in _ready:
        _ready.clear()
        _ready[path, remembered] = Bpe(path, remembered=remembered)
    return _ready[path, remembered]


class Pieces(dict):
    """Ids of pieces after a space, those met lately and, in ``old``, before that."""

    def __init__(self, bpe: Bpe) -> None:
        self.bpe, self.old = bpe, {}

    def renew(self) -> None:
        if len(self) > self.bpe.remembered:
            self.old = dict(self)
            self.clear()

    def __missing__(self, piece: str) -> bytes:
        """``piece`` comes after a space, or begins with the line break that it comes after."""
        ids = self.old.get(piece)
        if ids is None:
            broken = piece[0] == "\n"
            text = piece[1:] if broken else piece
            if "\n" in text:
                return self.lines(text, broken)
            m = WORD.fullmatch(text)
            if m is None or len(text) > 64:
                ids = self.bpe.piece(piece if broken else f" {piece}")
            elif m[2]:
                # The pattern parts letters from the signs that follow.
                ids = self[piece[: len(piece) - len(m[2])]] + self.signs(m[2])
            elif broken:
                ids = self.signs("\n") + self.bpe.word(text)
            else:
                ids = self.bpe.word(f" {text}")
        if len(piece) <= 64:
            self[piece] = ids
        return ids

    def lines(self, text: str, broken: bool) -> bytes:
        """A piece with line breaks: one between two characters is a token of its own."""
        parts = text.split("\n")
        if broken or any(not p or p[0].isspace() or p[-1].isspace() for p in parts):
            return self.bpe.piece(f"\n{text}" if broken else f" {text}")
        return b"".join([self[parts[0]], *[self[f"\n{p}"] for p in parts[1:]]])

    def signs(self, text: str) -> bytes:
        found = self.get(f" {text}")  # no piece begins with a space
        if found is None:
            found = self[f" {text}"] = self.bpe.piece(text)
        return found


def _letter_bytes() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a letter: itself where that can be printed, and
    the others, in order, as the letters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def slices(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, in groups of a few million characters."""
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size >= SLICE_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def _replaced(df: DataFrame, name: str) -> list[T.StructField]:
    return [f for f in df.schema.fields if f.name.lower() != name.lower()]


def encode_texts(df: DataFrame, text: str = "text", into: str = "ids", tokenizer: str | None = None) -> DataFrame:
    """All columns of ``df`` and ``into``: the ids as little-endian unsigned 32-bit integers."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    kept = _replaced(df, into)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ready(path)
        for batch in batches:
            row = 0
            for group in slices([t or "" for t in batch.column(text).to_pylist()]):
                part = batch.slice(row, len(group))
                row += len(group)
                ids = pa.array(bpe.encode(group), pa.binary())
                columns = [part.column(f.name) for f in kept]
                yield pa.RecordBatch.from_arrays([*columns, ids], names=[*[f.name for f in kept], into])

    return df.mapInArrow(encode, T.StructType([*kept, T.StructField(into, T.BinaryType())]))


def decode_ids(df: DataFrame, ids: str = "ids", into: str = "decoded", tokenizer: str | None = None) -> DataFrame:
    """All columns of ``df`` and ``into``: the text of the ids; null ids give the empty text."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    kept = _replaced(df, into)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ready(path)
        for batch in batches:
            texts = pa.array([bpe.decode(i.as_buffer() if i.is_valid else b"") for i in batch.column(ids)], pa.string())
            columns = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, texts], names=[*[f.name for f in kept], into])

    return df.mapInArrow(decode, T.StructType([*kept, T.StructField(into, T.StringType())]))


def op5_bpe_round_trip(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode_texts(docs).select("doc_id", "ids")
    return decode_ids(encoded).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
