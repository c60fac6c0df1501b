"""Phrases that stand together more often than their words would: Apriori candidates counted by double-array tries.

Texts are lower-cased (A-Z), cut into pieces and words; a phrase is a run of two
to `most` words inside a piece.  All is per language.

* Candidates.  A phrase can only reach `least` occurrences if every bucket it
  falls into does, where buckets are 64-bit hashes of phrases, and if both its
  ends without one word do (Apriori).  For each length numpy hashes the phrases
  at all text positions whose ends are alive, tasks add them up, and what they
  have goes by ranges of hashes to the tasks that add up all; the buckets that
  reach `least` are the next length's ends.  Texts ask a bitmap for them, as they
  do for candidates below; what it lets through wrongly is dropped where it is
  added up.  Buckets that collide only let more candidates through.  One run is
  spelled out for each bucket, for all lengths in one pass over the texts.
  Words of candidates are candidates, too, as their counts are needed.
* Counting.  Candidates are dealt by hash to shards, each a double-array trie
  over bytes in one task.  In one pass over the texts the runs that the bitmap
  lets through are compared byte by byte, and equal ones of a portion go with
  their number to the shard's task, which moves the states of all of them
  together through its trie, level by level; runs that fall out of the trie are
  dropped, and those it accepts are counted.  These counts are exact; the buckets
  and the bitmap only choose what is counted.
* Proof.  The counts of a bucket's phrases must add up to the bucket's own.
  Where they do not, a second phrase shares the hash, and all runs of that
  bucket are spelled out.

The passes over the texts are as many for any number of candidates.  What a task
holds is bounded (HELD, BUCKETS, SHARD); larger input makes more tasks.  The
bitmap is bounded, too (BITS): when it is full, more runs are added up, and none
is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardry.sources.workspace import staged

MOST = 3
LEAST = 10
TOP = 2000
HELD = 1 << 21
BUCKETS = 1 << 21
SHARD = 200_000
SHARDS_AT_ONCE = 4
PORTION = 1 << 22
CHUNK = 1 << 20
#: Bits of a bitmap for each hash in it, and at most.
BITS_EACH, BITS = 64, 1 << 29
#: Slices of a language's phrases that are ranked apart before their best are.
SLICES = 128
#: Bytes of runs that go through a trie together.
TOGETHER = 1 << 22

_SPACE, _END = 32, 10
#: Bytes as the words and pieces need them: A-Z small, tabs blank, marks that end a piece as line ends.
_BYTES = bytes(
    _END if chr(b) in ".,;:!?\n\x0b\f\r" else _SPACE if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_ONE, _HALF = np.uint64(1), np.uint64(32)


@lru_cache(maxsize=4)
def _powers_of(base: int, n: int) -> np.ndarray:
    powers = np.full(n, np.uint64(base))
    powers[0] = _ONE
    return np.multiply.accumulate(powers)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 to base**(n - 1) modulo 2**64, kept for sizes that come again."""
    return _powers_of(int(base), max(CHUNK, n))[:n]


def _gaps(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts' bytes, a line end after each, which of them part words, and which come after one that does."""
    raw = np.frombuffer(b"\n".join([*texts, b""]).translate(_BYTES) + b"\n", np.uint8)
    gap = (raw == _SPACE) | (raw == _END)
    return raw, gap, np.concatenate([[True], gap[:-1]])


class Pieces:
    """Texts of one language as bytes with single blanks, and where their words are."""

    def __init__(self, texts: list[bytes]):
        raw, gap, after_gap = _gaps(texts)
        kept = ~((raw == _SPACE) & after_gap)  # a blank after a blank or a line end goes
        self.data, gap = raw[kept], gap[kept]
        after_gap = np.concatenate([[True], gap[:-1]])
        self.starts = np.flatnonzero(~gap & after_gap)
        self.ends = np.flatnonzero(gap & ~after_gap)
        lines = np.cumsum(self.data == _END, dtype=np.int32)
        self.piece = lines[self.starts]

    def word_hashes(self) -> np.ndarray:
        """A polynomial in the word's bytes modulo 2**64, mixed."""
        out = np.empty(len(self.starts), np.uint64)
        at = 0
        while at < len(self.starts):
            low = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, low + CHUNK)))
            part = self.data[low : self.ends[to - 1]].astype(np.uint64) + _ONE
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * _powers(_ODD, len(part)), dtype=np.uint64)])
            first, last = self.starts[at:to] - low, self.ends[at:to] - low
            # a word further right has higher powers in its sum; the inverse brings all to the same
            out[at:to] = _mixed((sums[last] - sums[first]) * _powers(_INVERSE, len(part))[first])
            at = to
        return out

    def runs(self, hashes: np.ndarray, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each number of words up to `most`: which words begin a run of so many inside a piece, and the hashes of the runs."""
        inside, own = np.ones(len(hashes), bool), hashes
        for words in range(1, min(most, len(hashes)) + 1):
            if words > 1:
                inside, own = self.piece[words - 1 :] == self.piece[: len(hashes) - words + 1], _longer(own[:-1], hashes[words - 1 :])
            yield words, inside, own

    def hashes_at(self, hashes: np.ndarray, first: np.ndarray, words: int) -> np.ndarray:
        return reduce(lambda h, k: _longer(h, hashes[first + k]), range(1, words), hashes[first])

    def distinct(self, first: np.ndarray, words: int, own: np.ndarray, exact: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the runs of `words` words from `first` with hashes `own` one of each, by the upper half of its hash, the hash and the number.

        Neighbours in the order of hashes that agree in the hash, or if `exact` in all bytes, are one.
        """
        if not len(first):
            return first, own, first.astype(np.int32)
        places = np.uint64((1 << (len(first) - 1).bit_length()) - 1)
        keys = (own & ~places) | np.arange(len(own), dtype=np.uint64)
        keys.sort()  # far faster than argsort
        order = (keys & places).view(np.int64)
        first, own = first[order], own[order]
        same = own[1:] == own[:-1]
        if exact:
            self._compare(self.starts[first], self.ends[first + words - 1], same)
        at = np.flatnonzero(np.concatenate([[True], ~same]))
        return first[at], own[at], np.diff(np.append(at, len(own))).astype(np.int32)

    def _compare(self, starts: np.ndarray, ends: np.ndarray, same: np.ndarray) -> None:
        """Of neighbours marked as the same let only those be that have the same bytes."""
        lengths = ends - starts
        same &= lengths[1:] == lengths[:-1]
        eights = np.ndarray(len(self.data), "<u8", np.concatenate([self.data, np.zeros(7, np.uint8)]), strides=(1,))
        rest, done = np.flatnonzero(same), 0
        while len(rest):
            left = lengths[rest] - done
            differ = eights[starts[rest] + done] ^ eights[starts[rest + 1] + done]
            differ <<= np.maximum(0, 64 - 8 * left).astype(np.uint64)  # bytes beyond the run go
            same[rest[differ != 0]] = False
            rest, done = rest[(differ == 0) & (left > 8)], done + 8

    def lines(self, first: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the runs of `words` words from `first`, a line each, and where lines begin and the last ends."""
        starts = self.starts[first]
        lengths = self.ends[first + words - 1] - starts + 1
        offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)])
        out = self.data[np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)]
        out[offsets[1:] - 1] = _END
        return out, offsets


def _longer(own: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a run and the word after it."""
    with np.errstate(over="ignore"):
        return _mixed(own * _ODD + word)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _portions(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """The texts of a batch (lang, text) language by language, in portions."""
    texts: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for lang, text in zip(batch.column(0), batch.column(1)):
        lang, text = lang.as_py(), text.as_py()
        texts.setdefault(lang, []).append(text)
        sizes[lang] = sizes.get(lang, 0) + len(text)
        if sizes[lang] >= PORTION:
            yield lang, texts.pop(lang)
            del sizes[lang]
    yield from texts.items()


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, Pieces]]:
    for lang, texts in _portions(batch):
        yield lang, Pieces(texts)


def _hashes(lang: str, pieces: Pieces) -> np.ndarray:
    """Hashes of the words, others in each language."""
    salt = np.uint64(int.from_bytes(lang.encode(), "big") % ((1 << 64) - 59))
    return pieces.word_hashes() ^ _mixed(salt.reshape(1))


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Which of `parts` ranges a hash is in."""
    return ((hashes >> _HALF) * np.uint64(parts) >> _HALF).astype(np.int64)


def _part_of(bucket: str, parts: int) -> Column:
    return F.shiftright(F.shiftrightunsigned(bucket, 32) * parts, 32).cast("int")


@lru_cache(maxsize=4)
def _edges(parts: int) -> np.ndarray:
    return np.array([-(-(part << 32) // parts) << 32 for part in range(1, parts)], np.uint64)


def _dealt(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The parts that have some of the hashes, which are in order of their upper halves, and where each begins and the last ends."""
    bounds = np.concatenate([[0], np.searchsorted(hashes >> _HALF, _edges(parts) >> _HALF), [len(hashes)]])
    some = np.flatnonzero(np.diff(bounds))
    return some, np.append(bounds[some], len(hashes))


def _cut(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The bytes of the values from each bound to the next."""
    offsets = (bounds * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _values(scalar: pa.Scalar, kind: type) -> np.ndarray:
    return np.frombuffer(scalar.as_buffer(), kind)


class _Buckets:
    """Buckets counted in the task, and let go part by part when there are `held`."""

    def __init__(self, parts: int, held: int):
        self.parts, self.held, self.some, self.n = parts, held, [], 0

    def add(self, buckets: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.some.append(buckets)
        self.n += len(buckets)
        if self.n >= self.held:
            yield from self.out()

    def out(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            buckets = np.concatenate(self.some)
            self.some, self.n = [], 0
            buckets.sort()
            first = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
            counts, buckets = np.diff(np.append(first, len(buckets))).astype(np.int32), buckets[first]
            part, bounds = _dealt(buckets, self.parts)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), _cut(buckets, bounds), _cut(counts, bounds)], names=["part", "buckets", "n"])


class Bits:
    """A bitmap of hashes: each of `parts` ranges has `width` bits, and one that is not set says that no hash is there."""

    def __init__(self, parts: int, width: int, bits: np.ndarray):
        self.parts, self.width, self.bits = parts, width, bits

    def may_have(self, hashes: np.ndarray) -> np.ndarray:
        at = _part(hashes, self.parts * self.width)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).view(bool)


def bits_of(buckets: DataFrame, n: int, parts: int):
    """A broadcast bitmap of a column `bucket` of `n` hashes."""
    width = 8 * max(1, min(BITS, BITS_EACH * n) // (8 * parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            at = np.unique(_part(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), parts * width))
            some, bounds = np.unique(at // width, return_index=True)
            for part, places in zip(some.tolist(), np.split(at % width, bounds[1:])):
                own.setdefault(part, np.zeros(width, bool))[places] = True
        bits = [np.packbits(x, bitorder="little").tobytes() for x in own.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.int32()), pa.array(bits, pa.binary())], names=["part", "bits"])

    tasks = min(parts, max(1, -(-n // (HELD // 2))))
    dealt = buckets.select("bucket").repartitionById(tasks, _part_of("bucket", parts))
    out = np.zeros(parts * width // 8, np.uint8)
    for part, bits in zip(*dealt.mapInArrow(run, "part int, bits binary").toArrow().columns):
        at = part.as_py() * width // 8
        out[at : at + width // 8] |= _values(bits, np.uint8)
    return buckets.sparkSession.sparkContext.broadcast(Bits(parts, width, out))


def bucket_counts(texts: DataFrame, words: int, ends, parts: int, least: int, held: int = HELD) -> DataFrame:
    """bucket, n: occurrences of runs of `words` words by hash, from `least` on.

    Both ends of a run must be in the broadcast bitmap `ends`, if given.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Buckets(parts, held)
        for batch in batches:
            for lang, pieces in _by_lang(batch):
                alive = None
                for length, inside, own in pieces.runs(_hashes(lang, pieces), words):
                    if length == words:
                        yield from sums.add(own[inside if alive is None else inside & alive[1:] & alive[:-1]])
                    elif length == words - 1 and ends is not None:
                        alive = ends.value.may_have(own)
        yield from sums.out()

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            for part, buckets, counts in zip(*batch.columns):
                own.setdefault(part.as_py(), []).append((_values(buckets, np.uint64), _values(counts, np.int32)))
        for some in own.values():
            buckets, counts = map(np.concatenate, zip(*some))
            order = np.argsort(buckets)
            buckets = buckets[order]
            first = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
            counts = np.add.reduceat(counts[order], first, dtype=np.int64)
            full = counts >= least
            yield pa.RecordBatch.from_arrays([pa.array(buckets[first[full]].view(np.int64)), pa.array(counts[full])], names=["bucket", "n"])

    dealt = texts.mapInArrow(run, "part int, buckets binary, n binary").repartitionById(parts, "part")
    return dealt.mapInArrow(summed, "bucket long, n long")


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Rows of batches (part, lang, bytes ...), those of a part and language as one, their bytes one after another."""
    table = pa.Table.from_batches(batches)
    langs, part = table["lang"].combine_chunks().dictionary_encode(), table["part"].to_numpy()
    codes = langs.indices.to_numpy()
    order = np.lexsort((codes, part))
    codes, part = codes[order], part[order]
    first = np.flatnonzero(np.concatenate([[True], (codes[1:] != codes[:-1]) | (part[1:] != part[:-1])]))
    columns = [pa.array(part[first]), langs.dictionary.take(pa.array(codes[first]))]
    for name in table.column_names[2:]:
        values = pa.concat_arrays(table[name].chunks).take(pa.array(order))
        offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(order) + 1]
        ends = np.append(offsets[first], offsets[-1])
        columns.append(pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends), values.buffers()[2]]))
    return pa.RecordBatch.from_arrays(columns, names=table.column_names)


def runs_in(texts: DataFrame, words: list[int], bits, parts: int, exact: bool, held: int = HELD // 2) -> DataFrame:
    """part, lang, buckets, phrases, n: runs of so many words that a broadcast bitmap lets through, by part and language.

    Of a portion's runs that agree in the hash, or if `exact` in all bytes, one is there with the hash, its bytes as a line and their number.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n = [], 0
        for batch in batches:
            for lang, pieces in _by_lang(batch):
                for length, inside, own in pieces.runs(_hashes(lang, pieces), max(words)):
                    if length not in words:
                        continue
                    first = np.flatnonzero(inside & bits.value.may_have(own))
                    first, own, counts = pieces.distinct(first, length, own[first], exact)
                    part, bounds = _dealt(own, parts)
                    lines, offsets = pieces.lines(first, length)
                    columns = [pa.array(part, pa.int32()), pa.array([lang] * len(part), pa.string()), _cut(own, bounds), _cut(lines, offsets[bounds]), _cut(counts, bounds)]
                    out.append(pa.RecordBatch.from_arrays(columns, names=["part", "lang", "buckets", "phrases", "n"]))
                    n += len(first)
                    if n > held:
                        yield _joined(out)
                        out, n = [], 0
        if n:
            yield _joined(out)

    return texts.mapInArrow(run, "part int, lang string, buckets binary, phrases binary, n binary")


def _block(full: DataFrame, parts: int) -> tuple:
    """What `spelled` asks for buckets: a bitmap, and the buckets themselves."""
    return bits_of(full, full.count(), parts), full.select("bucket")


def spelled(texts: DataFrame, words: list[int], block, anywhere: bool = False, held: int = HELD // 2) -> DataFrame:
    """lang, phrase, bucket of the runs of so many words whose hash is in a block of buckets.

    One run is spelled for each bucket, or all that have its hash (`anywhere`).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, langs, lines = [], [], []
        for batch in batches:
            for lang, own, some in zip(*batch.columns):
                buckets.append(_values(own, np.uint64))
                langs.append(lang.as_py())
                lines.append(_values(some, np.uint8))
        if not buckets:
            return
        rows = np.cumsum([len(x) for x in buckets])
        buckets, data = np.concatenate(buckets), np.concatenate(lines)
        ends = np.flatnonzero(data == _END)
        starts = np.concatenate([[0], ends[:-1] + 1])
        data = data.tobytes()
        if anywhere:
            slices = map(data.__getitem__, map(slice, starts.tolist(), ends.tolist()))
            own = (langs[i] for i in np.searchsorted(rows, np.arange(len(buckets)), "right").tolist())
            found = list(zip(*set(zip(own, slices, buckets.view(np.int64).tolist()))))
        else:
            buckets, at = np.unique(buckets, return_index=True)
            found = [[langs[i] for i in np.searchsorted(rows, at, "right").tolist()], list(map(data.__getitem__, map(slice, starts[at].tolist(), ends[at].tolist()))), buckets.view(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, (pa.string(), pa.binary(), pa.int64()))], names=["lang", "phrase", "bucket"])

    bits, full = block
    parts = bits.value.parts
    dealt = runs_in(texts, words, bits, parts, anywhere, held).repartitionById(parts, "part")
    found = dealt.select("lang", "buckets", "phrases").mapInArrow(run, "lang string, phrase binary, bucket long")
    return found.join(full, "bucket", "left_semi").select("lang", "phrase", "bucket")  # the bitmap lets others through


class Trie:
    """A double array: from state s the byte c leads to base[s] + c if that place's check is s."""

    def __init__(self, phrases: list[bytes]):
        """`phrases` are distinct and sorted; phrase i is accepted with number i."""
        parents, symbols, accepts = self._tree(phrases)
        n = len(parents)
        children = np.bincount(parents[1:], minlength=n)
        low, high = np.full(n, 256), np.full(n, -1)
        np.minimum.at(low, parents[1:], symbols[1:])
        np.maximum.at(high, parents[1:], symbols[1:])
        several = np.flatnonzero(children > 1)
        widths = (high - low + 1)[several]
        offsets = np.cumsum(widths) - widths
        base = np.zeros(n, np.int64)
        base[several] = 1 + offsets - low[several]  # place 0 is the root
        place = np.zeros(n, np.int64)
        many = np.flatnonzero(children[parents] > 1)
        many = many[many > 0]
        place[many] = base[parents[many]] + symbols[many]
        size = 1 + int(widths.sum())
        used = np.zeros(size, bool)
        used[0], used[place[many]] = True, True
        single = np.flatnonzero(children[parents] == 1)
        single = single[single > 0]
        free = np.flatnonzero(~used)
        free = np.concatenate([free, np.arange(size, size + max(0, len(single) - len(free)))])[: len(single)]
        place[single] = free  # an only child fits into any hole
        base[parents[single]] = free - symbols[single]
        size = max(size, int(place.max(initial=0)) + 1)
        self.base, self.check, self.accept = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        self.base[place] = base
        self.check[place[1:]] = place[parents[1:]]
        self.accept[place] = accepts
        self.size = len(phrases)

    @staticmethod
    def _tree(phrases: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Parent, byte and accepted number of each node, level by level; node 0 is the root."""
        data = np.frombuffer(b"".join(phrases), np.uint8)
        lengths = np.array([len(p) for p in phrases], np.int64)
        starts = np.cumsum(lengths) - lengths
        node, rows, n = np.zeros(len(phrases), np.int64), np.arange(len(phrases)), 1
        parents, symbols, accepts = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], [np.full(1, -1)]
        depth = 0
        while True:
            rows = rows[lengths[rows] > depth]
            if not len(rows):
                break
            parent, symbol = node[rows], data[starts[rows] + depth].astype(np.int64)
            new = np.concatenate([[True], (parent[1:] != parent[:-1]) | (symbol[1:] != symbol[:-1])])
            node[rows] = n + np.cumsum(new) - 1
            done = np.full(int(new.sum()), -1)
            ending = rows[lengths[rows] == depth + 1]
            done[node[ending] - n] = ending
            parents.append(parent[new])
            symbols.append(symbol[new])
            accepts.append(done)
            n += len(done)
            depth += 1
        return np.concatenate(parents), np.concatenate(symbols), np.concatenate(accepts)

    def count(self, pieces: Pieces) -> np.ndarray:
        """Occurrences of each phrase: the states of all word starts advance together, a byte a level."""
        counts = np.zeros(self.size, np.int64)
        for numbers, _ in self._walk(pieces.data, pieces.starts, [_SPACE, _END]):
            counts += np.bincount(numbers, minlength=self.size)
        return counts

    def count_lines(self, data: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Sums of the weights of the lines that are a phrase."""
        starts = np.concatenate([[0], np.flatnonzero(data == _END)[:-1] + 1])
        numbers, lines = map(np.concatenate, zip(*self._walk(data, starts, [_END])))
        counts = np.zeros(self.size, np.int64)
        np.add.at(counts, numbers, weights[lines])
        return counts

    def _walk(self, data: np.ndarray, at: np.ndarray, ends: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Level by level the numbers of the phrases that end before one of the bytes `ends`, and which start each is from."""
        who, state, ending = np.arange(len(at)), np.zeros(len(at), np.int32), np.zeros(256, bool)
        ending[ends] = True
        while len(at):
            symbol = data[at]
            ended = np.flatnonzero(ending[symbol])
            numbers = self.accept[state[ended]]
            yield numbers[numbers >= 0], who[ended[numbers >= 0]]
            place = self.base[state] + symbol
            inside = (place >= 0) & (place < len(self.check))
            place = np.where(inside, place, 0)
            on = np.flatnonzero((self.check[place] == state) & (symbol != _END))
            at, state, who = at[on] + 1, place[on].astype(np.int32), who[on]


def trie_counts(rows: DataFrame) -> DataFrame:
    """lang, phrase, f for rows (part, lang, phrases, n) that are sorted so that a part's candidates of a language, without n, come before its runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, phrases, trie, counts, some, size = None, [], None, None, [], 0

        def add() -> None:
            nonlocal trie, counts, some, size
            if trie is None:
                phrases.sort()
                trie, counts = Trie(phrases), np.zeros(len(phrases), np.int64)
            if some and phrases:
                counts += trie.count_lines(*map(np.concatenate, zip(*some)))
            some, size = [], 0

        def out() -> pa.RecordBatch:
            add()
            kept = np.flatnonzero(counts)
            found = [pa.array([key[1]] * len(kept), pa.string()), pa.array([phrases[i] for i in kept.tolist()], pa.binary()), pa.array(counts[kept])]
            return pa.RecordBatch.from_arrays(found, names=["lang", "phrase", "f"])

        for batch in batches:
            for part, lang, lines, n in zip(*batch.columns):
                if (part.as_py(), lang.as_py()) != key:
                    if key is not None:
                        yield out()
                    key, phrases, trie, counts = (part.as_py(), lang.as_py()), [], None, None
                if not n.is_valid:
                    phrases += lines.as_py().split(b"\n")[:-1]
                    continue
                some.append((_values(lines, np.uint8), _values(n, np.int32)))
                size += len(some[-1][0])
                if size > TOGETHER:
                    add()
        if key is not None:
            yield out()

    return rows.mapInArrow(run, "lang string, phrase binary, f long")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def full_buckets(texts: DataFrame, most: int = MOST, least: int = LEAST, buckets: int = BUCKETS, occurrences: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The buckets that reach `least` (words, bucket, n), and their phrases (lang, phrase, bucket).

    A task adds up the buckets of about `buckets` occurrences of the texts' words, which are counted if not given.
    """
    if occurrences is None:
        occurrences = _all_words(word_totals(texts))
    parts = max(1, -(-occurrences // buckets))
    ends, full = None, []
    for words in range(2, most + 1):
        full.append(staged(bucket_counts(texts, words, ends, parts, least).withColumn("words", F.lit(words)), "phrase-buckets"))
        if ends is not None:
            ends.unpersist()
        if full[-1].isEmpty() or words == most:
            break
        ends, _ = _block(full[-1], parts)
    return _union(full), _spelled(texts, _union(full), most, parts * most)


def _spelled(texts: DataFrame, full: DataFrame, most: int, parts: int, anywhere: bool = False) -> DataFrame:
    block = _block(full, parts)
    found = staged(spelled(texts, list(range(2, most + 1)), block, anywhere=anywhere), "phrase-spelled")
    block[0].unpersist()
    return found


def shared_buckets(full: DataFrame, phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """Buckets with occurrences that the counts of their phrases do not account for."""
    named = phrases.select("lang", F.col("phrase").cast("string").alias("phrase"), "bucket")
    sums = named.join(counts, ["lang", "phrase"]).groupBy("bucket").agg(F.sum("f").alias("f"))
    return full.join(sums, "bucket", "left").filter(F.col("n") > F.coalesce("f", F.lit(0))).select(full.columns)


def counted_phrases(texts: DataFrame, most: int, least: int, buckets: int, shard: int, at_once: int, occurrences: int | None = None) -> DataFrame:
    """lang, phrase, f: all phrases of two to `most` words with `least` occurrences, their words, and some more."""
    if occurrences is None:
        occurrences = _all_words(word_totals(texts))
    parts = max(1, -(-occurrences // buckets))
    full, phrases = full_buckets(texts, most, least, buckets, occurrences)
    counts = staged(phrase_counts(texts, _with_words(phrases), shard, at_once, parts * most), "phrases")
    shared = staged(shared_buckets(full, phrases, counts), "phrase-shared")
    if shared.isEmpty():
        return counts
    more = _spelled(texts, shared, most, parts * most, anywhere=True)
    return staged(phrase_counts(texts, _with_words(phrases.unionByName(more)), shard, at_once, parts * most), "phrases")


def _with_words(phrases: DataFrame) -> DataFrame:
    """lang, phrase: the phrases and their words, each once."""
    phrases = phrases.select("lang", "phrase").distinct()
    words = phrases.select("lang", F.explode(F.split(F.col("phrase").cast("string"), " ")).alias("phrase")).distinct()
    return phrases.unionByName(words.withColumn("phrase", F.col("phrase").cast("binary")))


def _hashed(phrases: DataFrame) -> DataFrame:
    """lang, phrase, bucket, words: the phrases with their hashes and numbers of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for lang in set(langs.tolist()):
                own = batch.column(1).take(pa.array(np.flatnonzero(langs == lang))).to_pylist()
                pieces = Pieces(own)
                first = np.flatnonzero(np.concatenate([[True], pieces.piece[1:] != pieces.piece[:-1]]))
                words, hashes = np.diff(np.append(first, len(pieces.piece))), _hashes(lang, pieces)
                buckets = np.empty(len(own), np.uint64)
                for length in np.unique(words).tolist():
                    buckets[words == length] = pieces.hashes_at(hashes, first[words == length], length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(own), pa.string()), pa.array(own, pa.binary()), pa.array(buckets.view(np.int64)), pa.array(words, pa.int32())],
                    names=["lang", "phrase", "bucket", "words"],
                )

    return phrases.select("lang", F.col("phrase").cast("binary").alias("phrase")).mapInArrow(run, "lang string, phrase binary, bucket long, words int")


def _lines(phrases: DataFrame, parts: int) -> DataFrame:
    """part, lang, phrases, n: the phrases (lang, phrase, bucket) as lines by part and language; n is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own: dict[tuple[int, str], list[bytes]] = {}
            part = _part(batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64), parts)
            for key, phrase in zip(zip(part.tolist(), batch.column(0).to_pylist()), batch.column(1).to_pylist()):
                own.setdefault(key, []).append(phrase)
            columns = [[k[0] for k in own], [k[1] for k in own], [b"\n".join([*x, b""]) for x in own.values()], [None] * len(own)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.string(), pa.binary(), pa.binary()))], names=["part", "lang", "phrases", "n"])

    return phrases.select("lang", "phrase", "bucket").mapInArrow(run, "part int, lang string, phrases binary, n binary")


def phrase_counts(texts: DataFrame, phrases: DataFrame, shard: int = SHARD, at_once: int = SHARDS_AT_ONCE, shards: int = 1) -> DataFrame:
    """lang, phrase, f: exact counts of the candidates that occur.

    Shards have about `shard` candidates at most, and are `shards` at least, as each gets its share of the texts' runs.
    A task has up to `at_once` of them, one after another, and fewer if some cores had none else.
    """
    kept = staged(_hashed(phrases), "phrase-candidates")
    n, lengths = kept.count(), [r.words for r in kept.select("words").distinct().collect()]
    if not n:
        return kept.select("lang", F.col("phrase").cast("string").alias("phrase"), F.lit(0).cast("long").alias("f"))
    parts = max(shards, -(-n // shard))
    tasks = max(-(-parts // at_once), min(parts, texts.sparkSession.sparkContext.defaultParallelism))
    runs = runs_in(texts, lengths, bits_of(kept, n, parts), parts, True).drop("buckets")
    rows = _lines(kept, parts).unionByName(runs).repartitionById(tasks, "part").sortWithinPartitions("part", "lang", F.col("n").isNotNull())
    return trie_counts(rows).select("lang", F.col("phrase").cast("string").alias("phrase"), "f")


def word_totals(texts: DataFrame) -> DataFrame:
    """lang and n, all its word occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, int] = {}
        for batch in batches:
            for lang, some in _portions(batch):
                _, gap, after_gap = _gaps(some)
                sums[lang] = sums.get(lang, 0) + int(np.count_nonzero(~gap & after_gap))
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.int64())], names=["lang", "n"])

    return texts.mapInArrow(run, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n"))


def _all_words(totals: DataFrame) -> int:
    return totals.agg(F.sum("n")).first()[0] or 0


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)) in whole decimals; counts below 10**15."""
    whole = lambda c: c.cast("decimal(15,0)")
    return F.call_function("div", whole(a) * whole(a) * F.lit(1_000_000).cast("decimal(7,0)"), whole(left) * whole(right)).cast("long")


def _ranked(phrases: DataFrame, top: int) -> DataFrame:
    """The `top` best of each language with their rank; of each slice of a language first, so that no task sorts all of it."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    sliced = phrases.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(SLICES)))
    best = sliced.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).filter(F.col("rank") <= top)
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)


def collocations(docs: DataFrame, most: int = MOST, least: int = LEAST, top: int = TOP, buckets: int = BUCKETS, shard: int = SHARD, at_once: int = SHARDS_AT_ONCE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of two to `most` words.

    A phrase is scored by its worst cut (ties: the earliest), and dropped if a
    longer candidate that holds it is at least half as frequent.  Null lang
    counts as `und`, null text as empty; each row counts, also one that repeats
    another.  Ties of score go to the more frequent phrase, then by bytes.  Other
    columns are not read; an empty table gives no rows.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    totals = staged(word_totals(texts), "phrase-totals")
    counts = counted_phrases(texts, most, least, buckets, shard, at_once, _all_words(totals))
    words = F.split("phrase", " ")
    chosen = counts.filter((F.col("f") >= least) & F.col("phrase").contains(" ")).withColumn("words", words)
    runs = F.explode(
        F.filter(
            F.flatten(F.transform(F.sequence(F.lit(1), F.size("words")), lambda i: F.transform(F.sequence(F.lit(2), F.greatest(F.lit(2), F.size("words") - 1)), lambda m: F.slice("words", i, m)))),
            lambda run: (F.size(run) > 1) & (F.size(run) < F.size("words")),
        )
    )
    inside = (
        chosen.filter(F.size("words") > 2)
        .select("lang", "f", runs.alias("run"))
        .groupBy("lang", F.array_join("run", " ").alias("phrase"))
        .agg(F.max("f").alias("longer"))
    )
    left = (
        chosen.join(inside, ["lang", "phrase"], "left")
        .filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("f") * 50))
        .select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    )
    part = lambda column, name: counts.select("lang", F.col("phrase").alias(column), F.col("f").alias(name))
    cuts = (
        left.withColumn("_left", F.array_join(F.slice("words", 1, F.col("k")), " "))
        .withColumn("_right", F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " "))
        .join(part("_left", "l"), ["lang", "_left"])
        .join(part("_right", "r"), ["lang", "_right"])
        .withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    )
    worst = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    ranked = _ranked(worst.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"), top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
