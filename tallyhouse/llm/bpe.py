"""Byte-level BPE: encoding and decoding of whole texts.

Every text is cut into pre-tokens by position; each distinct pre-token of the corpus
is encoded once, in the partition its hash names; the ids return to the positions.
Decoding looks every id up in the table of token bytes, which has as many rows as the
vocabulary has tokens.

Null and empty texts have no ids and decode to nothing. Rows that repeat are answered
each by itself. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from tallyhouse.llm import exchange
from tallyhouse.llm.common import batches_of, id_text, packed, rows_of


@functools.lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@functools.lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    """Bytes by token id; ids that the vocabulary leaves free are empty."""
    ranks = load_ranks(path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


@functools.lru_cache(maxsize=2)
def _merger(path: str) -> Callable[[bytes], list[int]]:
    # The pattern is not used here: a pre-token is merged as one piece.
    encoding = tiktoken.Encoding("ranks", pat_str=".", mergeable_ranks=load_ranks(path), special_tokens={})
    return encoding._core_bpe.encode_single_piece


@functools.lru_cache(maxsize=4)
def _compiled(pattern: str):
    return regex.compile(pattern)


def pre_tokens(text: bytes, pattern: str) -> list[bytes]:
    """Each match of ``pattern``, in order, as bytes."""
    return [piece.encode() for piece in _compiled(pattern).findall(text.decode())]


def encoded(docs: DataFrame, ranks_path: str, pattern: str, finish, schema: str, arrow: pa.Schema,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode the texts and pass each document's ids (a numpy array) to ``finish``,
    which returns the columns after the id."""
    def answer(packs: Iterator[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
        merge, ids_of = _merger(ranks_path), {}
        for key, payload in packs:
            words, _ = exchange.words_in(payload)
            found = []
            for word in words:
                ids = ids_of.get(word)
                if ids is None:
                    ids = ids_of[word] = np.array(merge(word), np.uint32).tobytes()
                found.append(ids)
            lengths = np.fromiter((len(x) // 4 for x in found), np.uint32, len(found))
            yield key, packed(lengths, _narrow(np.frombuffer(b"".join(found), np.uint32)))

    def assemble(ids, lengths, codes, answers) -> Iterator[tuple]:
        of_word = [b""] * sum(len(members) for members, _ in answers)
        for members, (sizes, flat) in answers:
            body, ends = flat.astype(np.uint32).tobytes(), (np.cumsum(sizes, dtype=np.int64) * 4).tolist()
            for number, a, b in zip(members.tolist(), [0, *ends[:-1]], ends, strict=True):
                of_word[number] = body[a:b]
        at = 0
        for doc_id, n in zip(ids, lengths.tolist(), strict=True):
            tokens = np.frombuffer(b"".join(map(of_word.__getitem__, codes[at:at + n].tolist())), np.uint32)
            at += n
            yield doc_id, *finish(tokens)

    cut = exchange.cut(id_text(docs, id_col, text_col), functools.partial(pre_tokens, pattern=pattern), _no_counts)
    return exchange.assembled(exchange.answered(cut, answer), assemble, schema, arrow)


def _no_counts(_) -> bool:
    return False


def _narrow(ids: np.ndarray) -> np.ndarray:
    return ids.astype(np.uint16) if not len(ids) or ids.max() < 1 << 16 else ids


def encode(docs: DataFrame, ranks_path: str, pattern: str, **columns) -> DataFrame:
    """(doc_id, ids): the token ids of every text."""
    return encoded(docs, ranks_path, pattern, lambda ids: (ids.astype(np.int32),), "doc_id long, ids array<int>",
                   pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))]), **columns)


def decode(encoded_docs: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, decoded): the bytes of every list of ids; null ids decode to nothing."""
    arrow = pa.schema([("doc_id", pa.int64()), ("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(ranks_path)
        yield from batches_of(((doc_id, b"".join(map(table.__getitem__, ids or ())))
                               for doc_id, ids in rows_of(batches, "doc_id", "ids")), arrow)

    return (encoded_docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{ids_col}` ids")
            .mapInArrow(run, "doc_id long, decoded binary"))


def digests(docs: DataFrame, ranks_path: str, pattern: str, **columns) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encoded, then decoded from the ids."""
    def finish(ids: np.ndarray) -> tuple:
        table, numbers = token_bytes(ranks_path), ids.tolist()
        text = " ".join(map(str, numbers)).encode()
        return (len(numbers), hashlib.sha256(text).hexdigest(),
                hashlib.sha256(b"".join(map(table.__getitem__, numbers))).hexdigest())

    return encoded(docs, ranks_path, pattern, finish,
                   "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
                   pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                              ("decoded_sha256", pa.string())]), **columns)
