"""Byte-level BPE encoding and decoding with the ``tokenizers`` library.

A vocabulary is a file of ranks (base64 token, rank); its path is a parameter.
From the ranks follow the merges: a token's two parts are what the lower ranks
leave of its bytes.  The library's model works on characters, so each byte
stands for one printable character (the byte table) and back.

Texts go through Arrow batches.  The library cuts them by the pattern and
encodes each piece; a worker remembers the pieces it has met (``CACHE``
pieces at most, then it starts anew), since a corpus repeats its words.  Texts
of Latin letters and common signs only are cut by Python's ``re``, with the
pattern's classes written out for those characters: the same pieces, sooner.  Long
texts are cut before a blank that follows a visible character, where the
pattern always starts a new match, so memory stays bounded and ids stay the
same.

Defined results: a null or empty text has no tokens and decodes to nothing;
ids that are not in the vocabulary raise; bytes that are no whole character
(ids cut inside a character) stay as they are in ``bytes`` and become U+FFFD in
``text``; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import byte_slices, read_table, texts_as_bytes

CACHE = 100_000
CHUNK = 1 << 16
SLICE_BYTES = 1 << 19
#: Characters whose classes are the same in every Unicode version: letters, digits, white space, other signs.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_SIGNS = "¡-©«¬®-±´¶-¸»¿×÷‐-‧"
_LATIN = re.compile(f"[\\t-\\r -~{_LETTERS}{_SIGNS}]*")
_CUT = re.compile(r"(?<=\S) ")


def byte_table() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def _parts(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two tokens whose merge makes ``token``."""
    parts, below = [token[i:i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        rank, i = min((ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
        if rank >= below:
            raise ValueError(f"rank {below}: no merge of lower ranks makes {token!r}")
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


@functools.lru_cache(maxsize=4)
def load_vocabulary(path: str) -> tuple[str, tuple[bytes, ...]]:
    """(the library's model as JSON, the bytes of each id); runs on the driver."""
    from tokenizers import Tokenizer, models

    ranks, chars = read_ranks(path), byte_table()
    name = lambda token: "".join(chars[b] for b in token)
    merges = [tuple(map(name, _parts(t, ranks))) for t, _ in sorted(ranks.items(), key=lambda x: x[1]) if len(t) > 1]
    model = models.BPE(vocab={name(t): r for t, r in ranks.items()}, merges=merges, cache_capacity=0)
    table = [b""] * (max(ranks.values()) + 1)
    for t, r in ranks.items():
        table[r] = t
    return Tokenizer(model).to_str(), tuple(table)


def latin_pattern(pattern: str) -> re.Pattern | None:
    r"""``pattern`` for texts that :data:`_LATIN` matches: \\p{L} and \\p{N} as plain classes; None if it has others."""
    out, inside = [], False
    for token in re.findall(r"\\p\{\w+\}|\\.|.", pattern, re.DOTALL):
        inside = token == "[" or (inside and token != "]")
        plain = {r"\p{L}": _LETTERS, r"\p{N}": "0-9"}.get(token)
        out.append(token if plain is None else plain if inside else f"[{plain}]")
    try:
        return None if "\\p{" in "".join(out) else re.compile("".join(out), re.ASCII)
    except re.error:
        return None


class _Encoder:
    """Pieces to ids, in one Python worker."""

    def __init__(self, model: str, pattern: str) -> None:
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.model = Tokenizer.from_str(model)
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.split = pre_tokenizers.Split(Regex(pattern), "isolated")
        self.latin = latin_pattern(pattern)
        self.known: dict[str, bytes] = {}  # ids as 32-bit integers: a third of what a list takes

    def pieces(self, text: str) -> list[str]:
        if self.latin is not None and _LATIN.fullmatch(text):
            return self.latin.findall(text)
        return [p for part in _chunks(text) for p, _ in self.split.pre_tokenize_str(part)]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        known = self.known
        cut = [self.pieces(t) for t in texts]
        new = list({p for pieces in cut for p in pieces if p not in known})
        if len(known) + len(new) > CACHE:
            known.clear()
            new = list({p for pieces in cut for p in pieces})
        for at in range(0, len(new), 1000):
            some = new[at:at + 1000]
            known.update(zip(some, (array("i", e.ids).tobytes() for e in
                                    self.model.encode_batch_fast(some, add_special_tokens=False)), strict=True))
        return [np.frombuffer(b"".join(map(known.__getitem__, pieces)), np.int32) for pieces in cut]


def _chunks(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > CHUNK and (m := _CUT.search(text, at + CHUNK)):
        yield text[at:m.start()]
        at = m.start()
    if at < len(text):
        yield text[at:] if at else text


@functools.lru_cache(maxsize=2)
def _encoder(model: str, pattern: str) -> _Encoder:
    return _Encoder(model, pattern)


def token_chars(text: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and end of each token, from the tokens' byte lengths.

    A token that starts or ends inside a character counts it whole.
    """
    char_of = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80) - 1
    end = np.cumsum(lengths)
    return char_of[end - lengths], char_of[end - 1] + 1


def _lists(values: list, kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
    flat = np.concatenate(values) if values else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32), kind))


def _encoding(model: str, pattern: str, lengths: np.ndarray | None = None):
    """(key, text) batches -> key, ids; with the tokens' byte lengths also starts, ends."""
    names = ["key", "ids"] if lengths is None else ["key", "ids", "starts", "ends"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model, pattern)
        for whole in batches:
            for batch in byte_slices(whole, 1, SLICE_BYTES):
                raw = texts_as_bytes(batch.column(1))
                ids = encoder.ids([t.decode("utf-8", "replace") for t in raw])
                out = [batch.column(0), _lists(ids, pa.int32())]
                if lengths is not None:
                    spans = [token_chars(t.decode("utf-8", "replace").encode(), lengths[x])
                             if len(x) else (x, x) for t, x in zip(raw, ids, strict=True)]
                    out += [_lists([s[k] for s in spans], pa.int32()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(out, names=names)
        encoder.known.clear()  # an idle worker keeps no pieces
    return run


def _decoding(table: tuple[bytes, ...]):
    """(key, ids) batches -> key, ids, bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = np.array(table, dtype=object)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                lists = batch.column(1)
                flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
                raw = [b"".join(tokens[flat[a:b]].tolist()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(raw, pa.binary())],
                                                 names=["key", "ids", "bytes"])
    return run


def _keyed(rows: DataFrame, id_col: str, value: Column, name: str) -> tuple[DataFrame, str]:
    rows = rows.select(F.col(id_col).alias("key"), value.alias(name))
    return rows, rows.schema["key"].dataType.simpleString()


def _with_text(decoded: DataFrame, id_col: str, ids_col: str = "ids") -> DataFrame:
    return decoded.select(F.col("key").alias(id_col), F.col("ids").alias(ids_col), "bytes",
                          F.expr("make_valid_utf8(cast(bytes as string))").alias("text"))


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           offsets: bool = False) -> DataFrame:
    """id, ids; with ``offsets`` also starts and ends, the characters that each token covers."""
    model, table = load_vocabulary(ranks_path)
    lengths = np.array([len(t) for t in table], np.int64) if offsets else None
    rows, kind = _keyed(docs, id_col, F.col(text_col), "text")
    schema = f"key {kind}, ids array<int>" + (", starts array<int>, ends array<int>" if offsets else "")
    return rows.mapInArrow(_encoding(model, pattern, lengths), schema).withColumnRenamed("key", id_col)


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id, ids, bytes (exactly what was encoded) and text (with U+FFFD for what is no whole character)."""
    rows, kind = _keyed(encoded, id_col, F.coalesce(F.col(ids_col), F.array().cast("array<int>")), "ids")
    return _with_text(rows.mapInArrow(_decoding(load_vocabulary(ranks_path)[1]),
                                      f"key {kind}, ids array<int>, bytes binary"), id_col, ids_col)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What ``decode(encode(docs))`` gives, in one Python worker for each task instead of two."""
    model, table = load_vocabulary(ranks_path)
    encoding, decoding = _encoding(model, pattern), _decoding(table)
    rows, kind = _keyed(docs, id_col, F.col(text_col), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return decoding(encoding(batches))

    return _with_text(rows.mapInArrow(run, f"key {kind}, ids array<int>, bytes binary"), id_col)


def token_digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256 (of the decimal ids, joined by blanks), decoded_sha256 (of the decoded bytes)."""
    return round_trip(docs, ranks_path, pattern, id_col, text_col).select(
        id_col, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))


def op6_query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    return token_digests(read_table(spark, sf_dir, "documents"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
