"""Byte-level BPE by sentencepiece, on a model written straight from a rank file."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, functions as F

from candlemill.llm.common import by_batch, shipped
from candlemill.llm.tokens import chunks, lookup

shipped(__name__)

SHIFT = 0x100  # byte b is written as the character U+0100 + b: 256 letters, none of them white space
BETWEEN = "\u0001"  # not among them
Encoded = tuple[int, str, bytes]
TO_CHAR = {b: SHIFT + b for b in range(256)}


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def number(field: int, n: int) -> bytes:
    return varint(field << 3) + varint(n)


def block(field: int, data: bytes) -> bytes:
    return varint(field << 3 | 2) + varint(len(data)) + data


def mapped(data: bytes) -> str:
    """Bytes as a string of one character each, which sentencepiece can take for a sentence."""
    return data.decode("latin-1").translate(TO_CHAR)


def model(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece BPE model: piece i is the token of rank i, its score -i; an unknown piece ends it.

    BPE joins the neighbours whose joint piece has the best score, so a negative rank makes it join in rank order.
    """
    # fields of the public sentencepiece model format: pieces 1 (piece 1, score 2, type 3), trainer 2, normaliser 3
    pieces = [block(1, block(1, mapped(token).encode()) + b"\x15" + struct.pack("<f", -rank) + number(3, 1))
              for token, rank in sorted(ranks.items(), key=lambda x: x[1])]
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must be 0, 1, 2 and so on")
    unknown = block(1, block(1, b"<unk>") + b"\x15" + struct.pack("<f", 0) + number(3, 2))
    trainer = number(3, 2) + number(4, len(ranks) + 1) + number(40, len(ranks)) + number(41, 2**64 - 1) + number(42, 2**64 - 1) + number(43, 2**64 - 1)
    normaliser = block(1, b"identity") + number(3, 0) + number(4, 0) + number(5, 0)
    return b"".join(pieces) + unknown + block(2, trainer) + block(3, normaliser)


class ByteBpe:
    """Encodes texts and decodes ids of one rank file."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex
        import sentencepiece

        with open(ranks_path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model(self.ranks))
        self.matches = regex.compile(pattern).findall
        self.cuts: dict[str, Encoded] = {}
        back = {SHIFT + b: b for b in range(256)}
        self.tokens = [self.processor.id_to_piece(k).translate(back).encode("latin-1") for k in range(len(self.ranks))]
        self.names = [str(k) for k in range(len(self.ranks))]

    def encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        """Ids of single pre-tokens; one that is a token as it stands is that token.

        The others go to sentencepiece in one call, with a character between them that no piece of the model has: it
        comes back as the unknown piece, and nothing is joined across it.
        """
        data = [p.encode() for p in pieces]
        whole = list(map(self.ranks.get, data))
        rest = [d for d, k in zip(data, whole) if k is None]
        if not rest:
            return [[k] for k in whole]
        ids = self.processor.encode(BETWEEN.join([mapped(d) for d in rest]), out_type=int)
        cuts = [-1, *np.flatnonzero(np.array(ids) == len(self.ranks)).tolist(), len(ids)]
        made = iter([ids[a + 1:b] for a, b in zip(cuts, cuts[1:])])
        return [next(made) if k is None else [k] for k in whole]

    def told(self, ids: list[int]) -> Encoded:
        return len(ids), " ".join([self.names[k] for k in ids]), self.decode(ids)

    def encode_cuts(self, cuts: list[str]) -> list[Encoded]:
        found = list(map(self.matches, cuts))
        made = iter(self.encode_pieces([p for f in found for p in f]))
        return [self.told(next(made) if len(f) == 1 else [k for _ in f for k in next(made)]) for f in found]

    def encode(self, text: str) -> Encoded:
        """How many ids the text has, the ids as decimals joined by spaces, and the bytes that they decode to.

        Tokens decode one by one, so the encodings of stretches of the text are put together.
        """
        cut = chunks(text)
        if cut is None:
            return self.encode_cuts([text])[0]
        return joined(self.encode_cuts(cut[:1]) + lookup(self.cuts, cut[1], lambda some: self.encode_cuts([" " + c for c in some])))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.tokens[k] for k in ids])


def joined(parts: list[Encoded]) -> Encoded:
    if not parts:
        return 0, "", b""
    counts, decimals, decoded = zip(*parts)
    return sum(counts), " ".join(filter(None, decimals)), b"".join(decoded)


def encoded(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) of every whole text: token ids in an array, and the bytes that they decode to."""

    def make():
        bpe = ByteBpe(ranks_path, pattern)

        def step(doc_ids, texts):
            made = [bpe.encode((t or b"").decode("utf-8", "replace")) for t in texts]
            return [doc_ids, [list(map(int, decimals.split())) for _, decimals, _ in made], [decoded for _, _, decoded in made]]

        return step

    taken = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return by_batch(taken, make, "doc_id long, ids array<int>, decoded binary", "doc_id", "text")


def digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): the digest of ``encoded`` without moving ids out of the task.

    A null text counts as empty: no tokens and the digests of nothing. Null ids and repeated rows stay; other columns
    are ignored; an empty table gives no rows.
    """

    def make() -> Callable:
        bpe = ByteBpe(ranks_path, pattern)
        sha = lambda data: hashlib.sha256(data).hexdigest()

        def step(doc_ids, texts):
            made = [bpe.encode((t or b"").decode("utf-8", "replace")) for t in texts]
            return [doc_ids, [n for n, _, _ in made], [sha(decimals.encode()) for _, decimals, _ in made],
                    [sha(decoded) for _, _, decoded in made]]

        return step

    taken = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return by_batch(taken, make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", "doc_id", "text")
