"""Encoding and decoding with a SentencePiece vocabulary.

Pieces are the patterns of an Aho-Corasick automaton.  A text runs through it
once; at each position the output links give every piece that ends there,
longest first, and each relaxes the best score of that position.  The way back
from the end is the segmentation with the highest sum of piece scores.  Equal
sums go to the longer last piece.

A character that is no piece costs the lowest score less UNKNOWN_COST and is
written as the pieces of its bytes, or as the unknown piece if the vocabulary
has none.  Blanks become the mark U+2581, one more stands before the first
word.  No piece holds a mark after another character, so a text falls into
words that are encoded alone and remembered; a vocabulary with such pieces is
encoded whole.

Scores are used as the model has them.  For a vocabulary of the merge kind they
are negative merge ranks, so the result is the best path over them, which may
differ from that library's greedy merges; it is one valid segmentation and
decodes to the same text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from math import inf

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardry.llm.common import free_names

MARK = "▁"
UNKNOWN_COST = 10.0
REMEMBERED = 200_000
ROWS_AT_ONCE = 512
BYTES_AT_ONCE = 1 << 22
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Vocabulary:
    """Pieces with scores, their automaton, and what was encoded lately.

    Up to REMEMBERED words are remembered, and the REMEMBERED before them.
    """

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str]):
        """`kinds`: normal, byte, unknown or control, for each id."""
        self.pieces, self.scores = pieces, scores
        self.unknown = kinds.index("unknown") if "unknown" in kinds else None
        self.byte_id = {int(pieces[i][3:5], 16): i for i, k in enumerate(kinds) if k == "byte"}
        id_byte = {i: b for b, i in self.byte_id.items()}
        normal = [i for i, k in enumerate(kinds) if k == "normal"]
        self.single = {pieces[i] for i in normal if len(pieces[i]) == 1}
        self.floor = min((scores[i] for i in normal), default=0.0) - UNKNOWN_COST
        self.by_word = not any(MARK in pieces[i].lstrip(MARK) for i in normal)
        self.by_line = not any("\n" in pieces[i] for i in normal)
        self.line_end = tuple(self._spell("\n"))
        self.automaton = ahocorasick.Automaton()
        for i in normal:
            self.automaton.add_word(pieces[i], (len(pieces[i]), scores[i], i))
        self.automaton.make_automaton()
        unknown = "⁇".encode()
        self.bytes_of = [
            bytes([id_byte[i]]) if k == "byte" else unknown if k == "unknown" else b"" if k == "control" else pieces[i].encode()
            for i, k in enumerate(kinds)
        ]
        self.seen: dict[str, tuple[int, ...]] = {}
        self.seen_before: dict[str, tuple[int, ...]] = {}

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        model = sentencepiece.SentencePieceProcessor(model_file=path)

        def kind(i: int) -> str:
            if model.is_unknown(i):
                return "unknown"
            return "byte" if model.is_byte(i) else "control" if model.is_control(i) or model.is_unused(i) else "normal"

        ids = range(model.get_piece_size())
        return cls([model.id_to_piece(i) for i in ids], [model.get_score(i) for i in ids], [kind(i) for i in ids])

    def best_path(self, text: str) -> list[int]:
        """Ids of the best segmentation of a text in which blanks are marks already."""
        if not text or not len(self.automaton):
            return self._spell(text)
        if not self.single.issuperset(text):
            return self._best_path_with_unknown(text)
        # every position is reached by the piece of its own character
        n = len(text)
        best, back = [0.0] + [-inf] * n, [None] * (n + 1)
        for at, found in self.automaton.iter(text):
            length, score, _ = found
            end = at + 1
            total = best[end - length] + score
            if total > best[end]:
                best[end], back[end] = total, found
        ids: list[int] = []
        while n:
            length, _, piece = back[n]
            n -= length
            ids.append(piece)
        return ids[::-1]

    def _best_path_with_unknown(self, text: str) -> list[int]:
        n = len(text)
        best, back = [0.0] * (n + 1), [(-1, 1)] * (n + 1)
        done = 0

        def to_end(end: int) -> None:
            """Positions up to `end` that no piece has reached get the single unknown character."""
            nonlocal done
            while done < end:
                done += 1
                lone = best[done - 1] + self.floor
                if text[done - 1] not in self.single and (back[done][0] < 0 or lone > best[done]):
                    best[done], back[done] = lone, (-1, 1)

        for at, (length, score, piece) in self.automaton.iter(text):
            end = at + 1
            if end > done + 1:
                to_end(end - 1)
            total = best[end - length] + score
            if back[end][0] < 0 or total > best[end]:
                best[end], back[end] = total, (piece, length)
        to_end(n)
        ids: list[int] = []
        while n:
            piece, length = back[n]
            n -= length
            ids.extend([piece] if piece >= 0 else reversed(self._spell(text[n])))
        return ids[::-1]

    def _spell(self, text: str) -> list[int]:
        if len(self.byte_id) == 256:
            return [self.byte_id[b] for b in text.encode()]
        return [self.unknown] * len(text)

    def encode(self, text: str) -> list[int]:
        """Ids of a text; none for the empty one."""
        if not text:
            return []
        if not self.by_word:
            return self.best_path(MARK + text.replace(" ", MARK))
        out: list[tuple[int, ...]] = []
        for k, line in enumerate(text.split("\n") if self.by_line else [text]):
            if k:
                out.append(self.line_end)
            if "  " in line or line.startswith(" ") or line.endswith(" "):
                marked = line.replace(" ", MARK)
                out += [tuple(self.best_path(w)) for w in _WORD.findall(marked if k else MARK + marked)]
                continue
            words = line.split(" ")
            if k:
                out.append(self._remembered(words[0], ""))
                del words[0]
            found = list(map(self.seen.get, words))
            if None in found:
                found = [self._remembered(w, MARK) if ids is None else ids for w, ids in zip(words, found)]
            out += found
        return list(chain.from_iterable(out))

    def _remembered(self, word: str, before: str) -> tuple[int, ...]:
        """Ids of a word after a mark, or of one that begins a line, which goes under a name of its own."""
        name = word if before else f"\n{word}"
        ids = self.seen.get(name)
        if ids is None:
            ids = self.seen_before.get(name)
            if ids is None:
                ids = tuple(self.best_path(before + word))
            if len(word) < 64:
                if len(self.seen) >= REMEMBERED:
                    self.seen, self.seen_before = {}, self.seen
                self.seen[name] = ids
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of ids.  Byte pieces that are no UTF-8 give U+FFFD, unknown pieces U+2047."""
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def vocabulary(name: str) -> Vocabulary:
    """The vocabulary of a model file that was sent to this worker, built once."""
    return Vocabulary.load(SparkFiles.get(name))


def _sent(docs: DataFrame, model: str) -> str:
    docs.sparkSession.sparkContext.addFile(model)
    return model.rstrip("/").rsplit("/", 1)[-1]


def _place(rows: DataFrame, column: str) -> int:
    """Where a column stands, found as Spark finds it, in any case."""
    return [c.lower() for c in rows.columns].index(column.lower())


def _portions(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the lists of one portion, not of a whole batch, are in memory.

    A portion ends at ROWS_AT_ONCE rows, or with the row at which its texts or ids reach BYTES_AT_ONCE.
    """
    for batch in batches:
        values = batch.column(column)
        width = 1 if pa.types.is_string(values.type) else 4
        measure = pc.binary_length if width == 1 else pc.list_value_length
        start = size = 0
        for row, length in enumerate(measure(values).to_pylist()):
            size += (length or 0) * width
            if row + 1 - start == ROWS_AT_ONCE or size >= BYTES_AT_ONCE:
                yield batch.slice(start, row + 1 - start)
                start, size = row + 1, 0
        if start < len(batch):
            yield batch.slice(start)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """All columns of docs with token_ids, n_tokens and round_trip.

    `model` is the path of a SentencePiece model file, sent to the executors.
    round_trip says whether the ids decode to the text again; a text with
    U+2581 of its own does not, it comes back as a blank.  Null and empty texts
    have no ids and round_trip true.  Columns of these three names are replaced.
    """
    name = _sent(docs, model)
    source = docs.drop("token_ids", "n_tokens", "round_trip")
    place = _place(source, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(name)
        for batch in _portions(batches, place):
            texts = [t or "" for t in batch.column(place).to_pylist()]
            ids = [pieces.encode(t) for t in texts]
            same = [pieces.decode(i) == t for i, t in zip(ids, texts)]
            added = [pa.array(ids, pa.list_(pa.int32())), pa.array([len(i) for i in ids], pa.int64()), pa.array(same)]
            yield pa.RecordBatch.from_arrays(batch.columns + added, names=schema.names)

    schema = source.selectExpr(
        "*", "cast(null as array<int>) token_ids", "cast(null as bigint) n_tokens", "cast(null as boolean) round_trip"
    ).schema
    return source.mapInArrow(run, schema)


def decode(rows: DataFrame, model: str, ids: str = "token_ids", to: str = "text") -> DataFrame:
    """Rows with a column of text for a column of ids (null: null)."""
    name = _sent(rows, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(name)
        for batch in _portions(batches, len(schema) - 1):
            texts = [None if i is None else pieces.decode(i) for i in batch.column(batch.num_columns - 1).to_pylist()]
            own = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(texts, pa.string())], names=schema.names)

    source = rows.drop(to)
    schema = source.withColumn(to, F.lit(None).cast("string")).schema
    return source.select("*", rows[ids].alias(*free_names(source, "__ids"))).mapInArrow(run, schema)
