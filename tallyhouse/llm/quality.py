"""Quality rules, lines first.

Each line is judged by itself: a line without sentence punctuation, a line of navigation
(many separators), a line of boilerplate phrases, a line mostly of symbols and a line
seen before in its document fall. Then a document is rejected that lost too much of its
text, that has too few words, or that repeats its own three-word windows.

Null and empty texts have no words and are rejected. Rows that repeat are judged each
by itself, an empty table gives an empty result, and other columns do not take part.
"""

from __future__ import annotations

import dataclasses
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyhouse.llm.common import Numbered, batches_of, id_text, rows_of, ship

SYMBOLS = b"#*$%&|<>"


@dataclasses.dataclass(frozen=True)
class Rules:
    """Limits of the rules; a share is of the words of the text or line."""

    least_words: int = 50
    #: Most words in repeated three-word windows, in hundredths of all words.
    most_repeated: int = 50
    #: A line with more symbols than this to a word is navigation or junk.
    symbols_to_word: float = 0.3
    #: Closing characters of a sentence; a long line in which no word ends in one is a menu or a list.
    closing: str = ".!?…。！？:;\"'”’»)"
    #: Lines of fewer words than this may end without punctuation: headings stay.
    heading_words: int = 12
    #: A line this long in words that names one of these is boilerplate.
    boilerplate_words: int = 30
    boilerplate: tuple[str, ...] = (
        "cookie", "javascript", "lorem ipsum", "privacy policy", "terms of use", "terms of service",
        "all rights reserved", "copyright ©", "sign in to", "log in to", "subscribe to our", "click here")
    #: Most text, in hundredths of its words, that the line rules may take from a kept document.
    most_lost: int = 40


_NAVIGATION = re.compile(r"(?:^|\s)(?:\||»|>|›|·)(?=\s|$)")


def line_falls(line: str, word_ends: list[str], rules: Rules) -> bool:
    """Whether a line with words breaks a rule of its own, apart from repetition."""
    n_words = len(word_ends)
    if sum(map(line.count, "#*$%&|<>")) > rules.symbols_to_word * n_words:
        return True
    if len(_NAVIGATION.findall(line)) * 4 > n_words > 3:
        return True
    if n_words <= rules.boilerplate_words:
        lowered = line.lower()
        if any(phrase in lowered for phrase in rules.boilerplate):
            return True
    return n_words >= rules.heading_words and not any(end in rules.closing for end in word_ends)


def clean_lines(text: str, rules: Rules) -> tuple[list[str], int, int]:
    """Lines that stay, the words of the lines that fall, and how many lines with a word repeat an earlier one.

    Repeated lines fall, except the first. Lines without a word stay.
    """
    kept, lost, repeats, seen = [], 0, 0, set()
    for line in text.split("\n"):
        words = line.encode().split()
        if not words:
            kept.append(line)
            continue
        if line in seen:
            repeats += 1
            lost += len(words)
            continue
        seen.add(line)
        if line_falls(line, [word.decode()[-1] for word in words], rules):
            lost += len(words)
        else:
            kept.append(line)
    return kept, lost, repeats


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more in the text."""
    if len(words) < 4:
        return 0
    numbers = Numbered()
    codes = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    size = len(numbers)
    if size < 1 << 21:
        windows = (codes[:-2] * size + codes[1:-1]) * size + codes[2:]
    else:  # the product of three would not fit: number the pairs first
        pairs = np.unique(codes[:-1] * size + codes[1:], return_inverse=True)[1]
        windows = pairs[:-1] * size + codes[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    covered[:-2] |= twice
    covered[1:-1] |= twice
    covered[2:] |= twice
    return int(covered.sum())


def judge(text: bytes, rules: Rules) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, clean text."""
    words = text.split()
    plain = text.decode()
    lines, lost, repeats = clean_lines(plain, rules)
    n, repeated = len(words), repeated_words(words)
    blanks = sum(map(text.count, (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    failed = n < rules.least_words or 100 * repeated > rules.most_repeated * n
    kept = not failed and 100 * lost <= rules.most_lost * n
    return n, len(plain) - blanks, symbols, repeats, repeated, failed, kept, "\n".join(lines)


_FIELDS = [("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"),
           ("n_repeat_words", "long"), ("base_failed", "boolean"), ("kept", "boolean")]
_ARROW = [pa.field(name, pa.int64() if kind == "long" else pa.bool_()) for name, kind in _FIELDS]


def judged(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, counts, base_failed, kept, clean_text): the verdict and the lines that stay."""
    schema = pa.schema([("doc_id", pa.int64()), *_ARROW, ("clean_text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(((doc_id, *judge(text, rules)) for doc_id, text in rows_of(batches, "id", "text")), schema)

    return id_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, " + ", ".join(f"{n} {k}" for n, k in _FIELDS) + ", clean_text string")


def verdicts(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As :func:`judged`, without the text."""
    schema = pa.schema([("doc_id", pa.int64()), *_ARROW])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(((doc_id, *judge(text, rules)[:-1]) for doc_id, text in rows_of(batches, "id", "text")), schema)

    return id_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, " + ", ".join(f"{n} {k}" for n, k in _FIELDS))


def filtered(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns, untouched and in one pass."""
    return _passed(docs, rules, text_col, False)


def cleaned(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text") -> DataFrame:
    """As :func:`filtered`, with the lines that stay as the text; other columns as they were."""
    return _passed(docs, rules, text_col, True)


def _passed(docs: DataFrame, rules: Rules, text_col: str, clean: bool) -> DataFrame:
    ship(docs.sparkSession)
    columns = docs.columns
    place = columns.index(text_col)
    named = docs.toDF(*[f"c{i}" for i in range(len(columns))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [judge(text or b"", rules)[6:] for text in batch.column(place).cast(pa.binary()).to_pylist()]
            kept = batch.filter(pa.array([stays for stays, _ in found], pa.bool_()))
            if clean:
                texts = pa.array([text for stays, text in found if stays], batch.schema.field(place).type)
                kept = pa.record_batch([*kept.columns[:place], texts, *kept.columns[place + 1:]], schema=batch.schema)
            yield kept

    return named.mapInArrow(run, named.schema).toDF(*columns)
