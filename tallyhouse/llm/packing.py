"""Best-fit packing of tokenized documents into sequences, repacked until bounds certify it.

Documents longer than a sequence are cut into full sequences and a rest. The pieces are
dealt to partitions; each packs its own best-fit decreasing and compares its bins with
the lower bound of dual feasible functions. Bins of a partition that the bound cannot
certify are taken apart, and the pieces of the worst-filled bins of several partitions
are brought together and packed anew, until one partition of such bins is left.

Null and empty texts are the end id alone. Rows that repeat are packed each by itself;
an empty table gives an empty result; other columns do not take part.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import os
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyhouse.llm.common import batches_of, id_text, rows_of, shuffle_partitions, stored

#: Pieces that one task may hold and pack at once: some 50 bytes each.
TASK_PIECES = 200_000

#: Stretches of text whose ids a worker keeps; a full cache starts anew.
CACHED_WORDS = 700_000

#: Stretches that are encoded in one call, whose results are held at once.
BLOCK_WORDS = 1000

#: Functions of the second family that the bound tries.
ROUNDINGS = 60

#: Partitions whose open bins meet in one task of the next round.
FAN_IN = 32

#: Last round that a sequence id has room for.
LAST_ROUND = 63


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=2)
def _ends_of_words(path: str) -> np.ndarray | None:
    """Whether each id ends a pre-token; None if the vocabulary does not mark that."""
    tokenizer = _tokenizer(path)
    suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
    if not suffix:
        return None
    ends = np.zeros(tokenizer.get_vocab_size(), bool)
    ends[[number for token, number in tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
    return ends


#: Marks that may stand around the letters of a plain word, which are then pre-tokens of
#: their own. Not the apostrophe, which may begin a pre-token with letters.
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")

#: Beyond these, letters may change under the vocabulary's normal form.
_BEYOND_LATIN = re.compile("[^\u0000-\u00ff]")


def _encoded(path: str, text: str) -> bytes:
    return np.array(_tokenizer(path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()


class MarkIds(dict):
    """Ids of runs of marks."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self.path = path

    def __missing__(self, marks: str) -> bytes:
        value = self[marks] = _encoded(self.path, marks)
        return value


class WordIds(dict):
    """Ids, as little-endian 32-bit numbers, of stretches of text between blanks.

    The vocabulary's pre-tokens and added tokens never span white space, so a stretch is
    encoded alone; an added token that stands in it is read as the library reads it. Where
    the vocabulary marks the end of a pre-token, a plain word's letters are encoded once in
    lower case, as the vocabulary reads them, whatever marks stand around them.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        self.path = path
        self.letters: dict[str, bytes] = {}
        self.marks = MarkIds(path)

    def clear(self) -> None:
        super().clear()
        self.letters.clear()
        self.marks.clear()

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self]
        if len(self) + len(new) > CACHED_WORDS:
            self.clear()
            new = list(words)
        if _ends_of_words(self.path) is None:
            self._learn_any(new)
            return
        rest, plain, cores = [], [], []
        for word in new:
            core = word.strip(_MARKS)
            if core.isalpha() and "<|" not in word and (core.isascii() or not _BEYOND_LATIN.search(core)):
                plain.append(word)
                cores.append(core.lower())
            else:
                rest.append(word)
        self._learn_any(rest)
        self._learn_letters(list(set(cores).difference(self.letters)))
        letters, marks = self.letters, self.marks
        for word, core in zip(plain, cores, strict=True):
            if len(word) == len(core):
                self[word] = letters[core]
            else:
                at = len(word) - len(word.lstrip(_MARKS))
                self[word] = marks[word[:at]] + letters[core] + marks[word[at + len(core):]]

    def _learn_letters(self, cores: list[str]) -> None:
        """One text with a blank between the words; each ends with its one token that ends a word."""
        for first in range(0, len(cores), BLOCK_WORDS):
            block = cores[first:first + BLOCK_WORDS]
            found = _tokenizer(self.path).encode_batch_fast([" ".join(block)], add_special_tokens=False)[0]
            ids = np.array(found.ids, "<u4")
            body, at = ids.tobytes(), 0
            for core, end in zip(block, (4 * np.flatnonzero(_ends_of_words(self.path)[ids]) + 4).tolist(), strict=True):
                self.letters[core] = body[at:end]
                at = end

    def _learn_any(self, new: list[str]) -> None:
        tokenizer = _tokenizer(self.path)
        for word in new:
            if "<|" in word:  # an added token may take the blanks beside it
                self[word] = _encoded(self.path, word)
        plain = [w for w in new if "<|" not in w]
        for first in range(0, len(plain), BLOCK_WORDS):
            block = plain[first:first + BLOCK_WORDS]
            # One text with a blank between the stretches; a token belongs to the one it starts in.
            found = tokenizer.encode(" ".join(block), add_special_tokens=False)
            starts = np.fromiter(itertools.chain.from_iterable(found.offsets), np.int64, 2 * len(found.ids))[::2]
            ends = np.searchsorted(starts, np.cumsum([len(w) + 1 for w in block])).tolist()
            body, at = np.array(found.ids, "<u4").tobytes(), 0
            for word, end in zip(block, ends, strict=True):
                self[word] = body[4 * at:4 * end]
                at = end


@functools.lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def document_ids(texts: Sequence[bytes], path: str, end: int) -> Iterator[bytes]:
    """Each text's ids and the end id, as little-endian 32-bit numbers."""
    known, last = _word_ids(path), np.array([end], "<u4").tobytes()
    split = [text.decode().replace("\n", " ").split(" ") for text in texts]
    known.learn(set().union(*split) if split else set())
    for words in split:
        yield b"".join(map(known.__getitem__, words)) + last


def pieces(docs: DataFrame, tokenizer_path: str, room: int = 4096, end: int = 1,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the cut documents."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cut(rows: list[tuple]) -> Iterator[tuple]:
            for (doc_id, _), ids in zip(rows, document_ids([t for _, t in rows], tokenizer_path, end), strict=True):
                for piece, start in enumerate(range(0, len(ids) // 4, room)):
                    part = ids[4 * start:4 * (start + room)]
                    yield doc_id, piece, start, len(part) // 4, zlib.crc32(part)

        def out() -> Iterator[tuple]:
            held, size = [], 0
            for row in rows_of(batches, "id", "text"):
                held.append(row)
                size += len(row[1])
                if size >= 4 << 20:
                    yield from cut(held)
                    held, size = [], 0
            yield from cut(held)
            _word_ids(tokenizer_path).clear()  # the worker goes on to other stages
        yield from batches_of(out(), schema)

    return id_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def lower_bound(lengths: np.ndarray, room: int) -> int:
    """Bins that any packing needs: the best of two families of dual feasible functions.

    The first drops items up to k, counts those above room - k as whole bins, and adds up
    the rest. The second rounds (k + 1) times an item down to whole bins and counts each as
    a k-th, but leaves items that are an exact (k + 1)-th of a bin, or several, as they are:
    so of items a little above a third no three share a bin.
    """
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=room + 1)
    mass = np.cumsum(counts * np.arange(room + 1, dtype=np.int64))
    number = np.cumsum(counts)
    cuts = np.arange(room // 2 + 1)
    whole = number[room] - number[room - cuts]
    middle = mass[room - cuts] - np.where(cuts > 0, mass[np.maximum(cuts - 1, 0)], 0)
    best = int((whole + -(-middle // room)).max())
    sizes = np.flatnonzero(counts)
    k = np.arange(1, ROUNDINGS + 1)[:, None]
    parts = (k + 1) * sizes
    weight = np.where(parts % room == 0, k * sizes, parts // room * room)  # of k * room to a bin
    return max(best, int((-(-(weight * counts[sizes]).sum(1) // (k[:, 0] * room))).max()))


def best_fit(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of every item, and the fill of the bins."""
    bin_of, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(room + 1)]  # bins by the room left
    gaps: list[int] = []  # rooms left that some bin has, in order
    fill: list[int] = []
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        at = bisect.bisect_left(gaps, length)
        if at < len(gaps):
            gap = gaps[at]
            number = open_bins[gap].pop()
            if not open_bins[gap]:
                del gaps[at]
        else:
            gap, number = room, len(fill)
            fill.append(0)
        bin_of[item], offset[item] = number, fill[number]
        fill[number] += length
        left = gap - length
        if left:
            if not open_bins[left]:
                bisect.insort(gaps, left)
            open_bins[left].append(number)
    return bin_of, offset, np.array(fill, np.int64)


_PACKED = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
           "part long, round int, bin long, offset long, settled boolean")


def _packed_part(room: int, number: int):
    """Pack one partition. Bins stay where the bound certifies their number or where they
    are full; of the others the least-filled ones, as many as there are bins above the
    bound and one more, give up their pieces. Where a round saves none of the bins that
    were brought together, the bound is out of reach: all but the two least-filled stay."""
    def run(table: pa.Table) -> pa.Table:
        lengths = table["length"].to_numpy()
        bin_of, offset, fill = best_fit(lengths, room)
        gap = len(fill) - lower_bound(lengths, room)
        if number:
            held = np.stack([table["held_part"].to_numpy(), table["held_bin"].to_numpy()])
            before, old = np.unique(held, axis=1, return_inverse=True)
            if len(fill) >= before.shape[1]:
                bin_of, offset, gap = old.ravel(), table["held_offset"].to_numpy(), 0
                fill = np.bincount(bin_of, lengths).astype(np.int64)
        slack = np.argsort(fill, kind="stable")[:2 * gap + 2]
        settled = np.ones(len(fill), bool)
        settled[slack[fill[slack] < room]] = False
        columns = {**{n: table[n] for n in ("doc_id", "piece", "start", "length", "ids_crc32", "part")},
                   "round": pa.array(np.full(len(lengths), number, np.int32)), "bin": pa.array(bin_of),
                   "offset": pa.array(offset), "settled": pa.array(settled[bin_of])}
        return pa.table(columns)
    return run


def packed(cut: DataFrame, room: int = 4096) -> DataFrame:
    """``cut`` (as of :func:`pieces`) with sequence_id and offset.

    Rounds: all pieces in partitions of at most TASK_PIECES on average; then the
    unsettled bins of FAN_IN partitions together, or of fewer where they would have more
    than TASK_PIECES, until they fit one partition. Every round is written, so no round
    is packed twice with different results.
    """
    spark = cut.sparkSession
    cut = stored(cut, "pieces")
    own = cut.filter(F.col("length") >= room)
    rest = cut.filter(F.col("length") < room)
    number_of = rest.count()
    parts = max(1, min(shuffle_partitions(spark), number_of // 2000), -(-number_of // TASK_PIECES))
    spread = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(parts))
    open_pieces = rest.withColumn("part", spread.cast("long"))
    settled, number = [], 0
    while True:
        done = stored(open_pieces.groupBy("part").applyInArrow(_packed_part(room, number), _PACKED), f"packed-{number}")
        left = done.filter("not settled")
        unsettled = left.count() if parts > 1 and number < LAST_ROUND else 0
        if not unsettled:
            settled.append(done)
            break
        settled.append(done.filter("settled"))
        parts = max(-(-parts // FAN_IN), -(-unsettled // TASK_PIECES))
        number += 1
        open_pieces = (left.drop("round", "settled").withColumnsRenamed({n: f"held_{n}" for n in ("part", "bin", "offset")})
                       .withColumn("part", F.pmod(F.xxhash64("held_part", "held_bin", F.lit(number)), F.lit(parts))))
    result = functools.reduce(DataFrame.unionByName, settled)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    # 6 bits of the round, 32 of the partition and 25 of the bin; full pieces below zero.
    in_bins = result.select(*columns, (F.col("round").cast("long") * (1 << 57) + F.col("part") * (1 << 25)
                                       + F.col("bin")).alias("sequence_id"), "offset")
    alone = own.select(*columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
                       F.lit(0).cast("long").alias("offset"))
    return in_bins.unionByName(alone)
