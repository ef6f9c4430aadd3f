"""Byte-level BPE encoding and decoding with tiktoken and a local rank file."""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import map_arrow, table

#: A text longer than this is encoded in pieces of about this many characters.
PIECE = 1 << 16
#: A run of white space from this length on isn't given to the regex engine.
LONG_SPACE = 1 << 12
# fixed values: the characters of the pattern's \s, Unicode's White_Space
_SPACES = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_SPACE)
_CUT = re.compile(r"(?<=\S)[ \n]")


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str = public_tokenizers.PATTERN) -> tiktoken.Encoding:
    """The encoding of a rank file (``.tiktoken``), or of a byte-level BPE
    vocabulary (``.json``) whose ids are in the order of its merges.

    Special tokens are the added tokens of a vocabulary; a rank file has none, and
    their strings in a text are then ordinary text.
    """
    special: dict[str, int] = {}
    if path.endswith(".json"):
        ranks, special = _json_ranks(path)
    else:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


def _json_ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """token bytes: id, and added token: id. Printable characters stand for their own
    byte, the rest of the 256 bytes, in order, for the characters from U+0100."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    added = file.get("added_tokens", [])
    if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"{path}: an added token isn't matched as it stands")
    special = {t["content"]: t["id"] for t in added}
    return {bytes(byte[c] for c in token): i for token, i in file["model"]["vocab"].items() if token not in special}, special


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """Cut ``text`` where no match of the pattern can reach across.

    A cut is before a space or line feed that follows a character which isn't
    white space: no match goes on over white space after another character, the
    look-ahead for white space can't be at that end, and nothing looks back. A
    stretch without such a place stays whole.
    """
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def encode(text: str | None, bpe: tiktoken.Encoding) -> list[int]:
    """The ids of ``text``; null has none, like the empty text.

    A special token is its id wherever it stands, the longest where several begin,
    and the texts around it are encoded each on its own.
    """
    if not text:
        return []
    special = [t for t in bpe.special_tokens_set if t in text]
    if special:
        parts = re.split(f"({'|'.join(map(re.escape, sorted(special, key=len, reverse=True)))})", text)
        return [i for n, part in enumerate(parts) for i in ([bpe.encode_single_token(part)] if n % 2 else _ordinary(part, bpe))]
    return _ordinary(text, bpe)


def _ordinary(text: str, bpe: tiktoken.Encoding) -> list[int]:
    """Long runs of white space go to the merges as the pattern's own matches: the whole
    run at a text's end, else all but its last character, as ``\\s+(?!\\S)`` leaves that to
    the next match. The regex engine would step back through such a run, which takes a
    stack as deep as the run and time in its square."""
    if len(text) < LONG_SPACE:
        return bpe.encode_ordinary(text)
    out: list[int] = []
    at = 0
    for run in _SPACES.finditer(text):
        end = run.end() - (run.end() < len(text))
        out += _pieced(text[at : run.start()], bpe)
        out += bpe._encode_single_piece(text[run.start() : end])
        at = end
    return out + _pieced(text[at:], bpe)


def _pieced(text: str, bpe: tiktoken.Encoding) -> list[int]:
    if len(text) <= PIECE:
        return bpe.encode_ordinary(text)
    return [i for piece in pieces(text) for i in bpe.encode_ordinary(piece)]


def encoded(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids`` (array<int>) per row; other columns are not read.

    Null and empty texts have no ids; repeated rows stay; an empty table gives an
    empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoding(path)
        for batch in batches:
            ids = pa.array([encode(t.as_py(), bpe) for t in batch.column(1)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["key", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return map_arrow(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decoded(rows: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and ``bytes`` (binary): the raw bytes of each row's ids; null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoding(path)
        for batch in batches:
            out = pa.array([None if t is None else bpe.decode_bytes(t) for t in batch.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), out], ["key", "bytes"])

    kind = rows.schema[key].dataType.simpleString()
    return map_arrow(rows.select(F.col(key).alias("key"), F.col(ids).alias("ids")), run, f"key {kind}, bytes binary").withColumnRenamed("key", key)


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode every text in one pass, returning digests instead of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoding(path)
        numbers = [str(i) for i in range(bpe.n_vocab)]
        for batch in batches:
            n, of_ids, of_bytes = [], [], []
            for t in batch.column(1):
                ids = encode(t.as_py(), bpe)
                n.append(len(ids))
                of_ids.append(hashlib.sha256(",".join([numbers[i] for i in ids]).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(bpe.decode_bytes(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids), pa.array(of_bytes)],
                ["key", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_arrow(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), run, schema).withColumnRenamed("key", key)


def op4_bpe(spark: SparkSession, sf_dir: str, path: str = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas) and
    decoded_sha256 (of the bytes that the ids decode to) of every whole text.

    Null and empty texts have no ids; repeated rows stay; an empty table gives an empty
    result; other columns are not read.
    """
    return digests(table(spark, sf_dir, "documents"), path)
