"""Byte-level BPE over Arrow batches, and back.

The vocabulary is a file of ranks (base64 token and rank per line). From the ranks the
merges of the ``tokenizers`` library are rebuilt: the two parts of a token are what the
lower ranks make of its bytes. Text is cut by the pattern, every piece is encoded by the
library through the byte-to-character table, and what a task has seen is kept, up to a bound,
so a repeated piece is looked up. Decoding reverses the byte table: bytes are
put together first and made into characters last, so a character split over tokens is whole
again.

A null text counts as empty and has no tokens. Texts are encoded whole, repeated rows alike;
an empty table gives an empty result. Only the named columns are read: the result has the
key, the ids and the offsets under fixed names.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from milepost.llm.common import pieces, text_bytes

# Arrow batches are worked on in parts of about this many bytes of text.
PART_BYTES = 1_000_000
# Pieces remembered per task; beyond it the table starts anew.
KEPT_PIECES = 200_000


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def parts_of(token: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """What the merges of lower rank make of a token's bytes."""
    parts, own = [token[i : i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        best, at = min((ranks.get(a + b, own), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if best >= own:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


def build_tokenizer(ranks: dict[bytes, int]) -> str:
    """The ``tokenizers`` model of a rank file, as JSON; input is mapped to byte characters."""
    from tokenizers import Tokenizer, models

    table = byte_characters()
    name = lambda token: "".join(table[b] for b in token)
    merges = []
    for token in sorted(ranks, key=ranks.get):
        if len(token) > 1:
            parts = parts_of(token, ranks)
            if len(parts) != 2:
                raise ValueError(f"rank {ranks[token]} is not a merge of two lower ranks")
            merges.append((name(parts[0]), name(parts[1])))
    vocab = {name(token): rank for token, rank in ranks.items()}
    return Tokenizer(models.BPE(vocab=vocab, merges=merges)).to_str()


class Encoder:
    """Encoder of one task: the library's model, the pattern, and the pieces seen so far."""

    def __init__(self, model: str, pattern: str):
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.pattern = regex.compile(pattern)
        self.model = Tokenizer.from_str(model)
        # Maps bytes to characters; offsets come back in characters of the piece.
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        self.first = np.zeros(1, np.int64)  # of each piece, its first token; one entry more at the end
        self.ids, self.starts = np.zeros(0, "<u4"), np.zeros(0, "<u4")

    def learn(self, new: list[str]) -> None:
        """Encode unseen pieces by one call of the library and keep their tokens."""
        coded = self.model.encode(new, is_pretokenized=True, add_special_tokens=False)
        counts = np.bincount(np.array(coded.word_ids, np.int64), minlength=len(new))
        self.places.update(zip(new, range(len(self.places), len(self.places) + len(new)), strict=True))
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(counts)])
        self.ids = np.concatenate([self.ids, np.array(coded.ids, "<u4")])
        self.starts = np.concatenate([self.starts, np.array(coded.offsets, "<u4")[:, 0]])

    def encode(self, texts: list[str], offsets: bool) -> list[tuple[bytes, bytes | None]]:
        """Per text its ids and, if asked for, the first characters of its tokens, packed."""
        found = [self.pattern.findall(x) for x in texts]
        if len(self.places) > KEPT_PIECES:
            self.forget()
        if new := set(chain.from_iterable(found)).difference(self.places):
            self.learn(list(new))
        out = []
        for own in found:
            place = np.fromiter(map(self.places.__getitem__, own), np.int64, len(own))
            first, tokens = self.first[place], self.first[place + 1] - self.first[place]
            at = np.repeat(first - np.cumsum(tokens) + tokens, tokens) + np.arange(tokens.sum())
            begins = None
            if offsets:
                lengths = np.fromiter(map(len, own), np.int64, len(own))
                begins = (np.repeat(np.cumsum(lengths) - lengths, tokens) + self.starts[at]).astype("<u4").tobytes()
            out.append((self.ids[at].tobytes(), begins))
        return out


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text", offsets: bool = True
) -> DataFrame:
    """Per row: key, ``ids`` and ``starts`` (binary, unsigned 32-bit little-endian), ``n_tokens``.

    ``starts`` has the character at which each token begins; it is null without ``offsets``.
    """
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(build_tokenizer(read_ranks(ranks_path)))  # the vocabulary's size, whatever the input

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(shared.value, pattern)
            for part in pieces(batch, "_text", PART_BYTES):
                rows = encoder.encode([x or "" for x in part.column("_text").to_pylist()], offsets)
                ids = pa.array([a for a, _ in rows], pa.binary())
                starts = pa.array([b for _, b in rows], pa.binary())
                counts = pa.array([len(a) // 4 for a, _ in rows], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("_key"), ids, starts, counts], names)

    names = [key, "ids", "starts", "n_tokens"]
    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(docs[key].alias("_key"), docs[text].alias("_text"))
    return narrow.mapInArrow(coded, f"`{key}` {kind}, ids binary, starts binary, n_tokens long")


def decode_stream(chunks: Iterable[bytes], ranks: dict[bytes, int]) -> Iterator[str]:
    """Texts of consecutive runs of packed ids; a character cut by a run's end comes whole with the next."""
    tokens = {rank: token for token, rank in ranks.items()}
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    for ids in chunks:
        yield decoder.decode(b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()]))
    yield decoder.decode(b"", final=True)


def decode(coded: DataFrame, ranks_path: str, key: str = "doc_id") -> DataFrame:
    """Per row of ``encode``'s result: its columns, ``decoded`` (binary) and ``decoded_text``."""
    table = byte_characters()
    names = {"".join(table[b] for b in token): rank for token, rank in read_ranks(ranks_path).items()}
    shared = coded.sparkSession.sparkContext.broadcast(names)
    fields = [f"`{x.name}` {x.dataType.simpleString()}" for x in coded.schema]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = None
        for batch in batches:
            if tokens is None:
                back = {character: byte for byte, character in enumerate(byte_characters())}
                tokens = [b""] * (max(shared.value.values()) + 1)
                for name, rank in shared.value.items():
                    tokens[rank] = bytes(back[c] for c in name)
            for part in pieces(batch, "ids", PART_BYTES):
                flat, at = text_bytes(part.column("ids"))
                ids = flat.view("<u4").tolist() if len(flat) else []
                raw = [b"".join([tokens[i] for i in ids[a // 4 : b // 4]]) for a, b in zip(at, at[1:], strict=False)]
                texts = [x.decode("utf-8", "replace") for x in raw]
                columns = [*part.columns, pa.array(raw, pa.binary()), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "decoded", "decoded_text"])

    return coded.mapInArrow(decoded, ", ".join([*fields, "decoded binary", "decoded_text string"]))


def round_trip(
    docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row the columns of ``encode``, ``ids_sha256``, and ``decoded_sha256`` of the ids decoded again.

    Texts are encoded, decoded and hashed in one pass over Arrow batches, so neither ids nor
    texts go through a second worker, and the decoded bytes leave a task as their hash only.
    """
    ranks = read_ranks(ranks_path)
    shared = docs.sparkSession.sparkContext.broadcast((build_tokenizer(ranks), ranks))  # the vocabulary's size

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, tokens = None, []
        for batch in batches:
            if encoder is None:
                encoder = Encoder(shared.value[0], pattern)
                tokens = [b""] * (max(shared.value[1].values()) + 1)
                for token, rank in shared.value[1].items():
                    tokens[rank] = token
            for part in pieces(batch, "_text", PART_BYTES):
                rows = encoder.encode([x or "" for x in part.column("_text").to_pylist()], True)
                ids = [a for a, _ in rows]
                raw = (b"".join([tokens[i] for i in np.frombuffer(a, "<u4").tolist()]) for a in ids)
                columns = [
                    part.column("_key"),
                    pa.array(ids, pa.binary()),
                    pa.array([b for _, b in rows], pa.binary()),
                    pa.array([len(a) // 4 for a in ids], pa.int64()),
                    pa.array([hashlib.sha256(a).hexdigest() for a in ids], pa.string()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in raw], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = [key, "ids", "starts", "n_tokens", "ids_sha256", "decoded_sha256"]
    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(docs[key].alias("_key"), docs[text].alias("_text"))
    schema = f"`{key}` {kind}, ids binary, starts binary, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return narrow.mapInArrow(coded, schema)
