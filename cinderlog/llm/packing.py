"""Operator 2: packing by power-of-two decomposition."""

from __future__ import annotations

import functools
import json
import os
import re
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, slices

#: Distinct chunks that a worker remembers.
CACHE = 150_000
#: Longest sequence; a power of two.
LENGTH = 1024
#: Id that ends each document.
END = 0
#: Where a text can't be cut at single spaces and line ends: other or repeated white space, or what may be a special token.
ODD = re.compile(r"[^\S \n]|\s\s|[\x1c-\x1f]|<\||\A\s|\s\Z")
#: A sign after a letter starts a chunk, too. By byte: 1 for the two separators; 2 for a byte of which only ODD can tell.
SIGN, LETTER = (np.isin(np.arange(256), np.frombuffer(x, np.uint8)) for x in (b"!\"#$%&()*+,-./:;<=>?@[]^_{|}~", bytes(range(65, 91)) + bytes(range(97, 123))))
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x0A]] = 1
KIND[[*range(10), *range(11, 32), 0x85, 0xA0, 0xE1, 0xE2, 0xE3, ord("|")]] = 2


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _odd(x: bytes) -> bool:
    k = KIND[np.frombuffer(x, np.uint8)]
    return bool(len(k) and (k[0] == 1 or k[-1] == 1 or (k[1:] & k[:-1] & 1).any() or (k == 2).any())) and ODD.search(x.decode()) is not None


class Encoder:
    """Texts to ids, as little-endian unsigned 32-bit bytes.

    Words repeat, so texts are cut before each space and around each line end, and between a letter and a sign, where the
    tokenizer's own rule always cuts, and a worker encodes each distinct chunk once while it remembers it. Chunks go through a faster encoder of the same merges where the file is byte-level BPE whose ids
    follow its merges; that gives the same ids. Texts with other or repeated white space are encoded whole; those that may hold a
    special token, and all texts of other files, by the tokenizer itself.
    """

    def __init__(self, path: str):
        self.path = path
        self.fast = self._same(json.loads(Path(path).read_text(encoding="utf-8")))
        if self.fast:
            self.line_end = self.fast.encode_ordinary("\n")[0]
            self.known = {b"\n": self.line_end.to_bytes(4, "little")}

    @functools.cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        return Tokenizer.from_file(self.path)

    @staticmethod
    def _same(file: dict):
        """The faster encoder, if the file's ids are those of its bytes and then its merges, in order."""
        import tiktoken
        from public_tokenizers import PATTERN

        model, before = file["model"], file["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
        if not plain or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex") or file["normalizer"]:
            return None
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(c): c for c in shown} | {chr(256 + i): c for i, c in enumerate(sorted({*range(256)} - {*shown}))}
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        if len(model["vocab"]) != 256 + len(merged) or any(model["vocab"].get(m) != 256 + i for i, m in enumerate(merged)):
            return None
        ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items()}
        return tiktoken.Encoding("chunks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(x.ids, "<u4").tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def regular(self, texts: list[bytes]) -> list[bytes]:
        """Of texts that can be cut; a line end stands between them."""
        whole = b"\n".join(texts)
        data = np.frombuffer(whole, np.uint8)
        line = data == 0x0A
        cut = line | (data == 0x20)
        cut[1:] |= line[:-1] | SIGN[data[1:]] & LETTER[data[:-1]]
        cut[0] = True
        cuts = np.append(np.nonzero(cut)[0], len(data))
        chunks = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(whole)]).dictionary_encode()
        kinds = chunks.dictionary.to_pylist()
        found = list(map(self.known.get, kinds))
        if fresh := [i for i, x in enumerate(found) if x is None]:
            ids = np.asarray(self.fast.encode_ordinary(b"\n".join([*(kinds[i] for i in fresh), b""]).decode()), "<u4")
            ends = (np.nonzero(ids == self.line_end)[0] * 4).tolist()
            ids = ids.tobytes()
            for i, a, b in zip(fresh, [0, *(x + 4 for x in ends[:-1])], ends, strict=True):
                found[i] = ids[a:b]
            if len(self.known) > CACHE:
                self.known = {b"\n": self.known[b"\n"]}
            self.known.update((kinds[i], found[i]) for i in fresh)
        ids = np.frombuffer(b"".join(found), "<u4")
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        start = np.cumsum(size) - size
        at = chunks.indices.to_numpy()
        n = size[at]
        total = np.concatenate([[0], np.cumsum(n)])
        where = np.repeat((start[at] - total[:-1]).astype(np.int32), n)
        where += np.arange(total[-1], dtype=np.int32)
        out = ids[where]
        first = np.cumsum([0, *(len(x) + 1 for x in texts)])
        a, b = np.searchsorted(cuts, first[:-1]), np.searchsorted(cuts, first[1:] - 1)
        return [out[total[i] : total[j]].tobytes() for i, j in zip(a.tolist(), b.tolist(), strict=True)]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if self.fast is None:
            return self.ids([x.decode() for x in texts])
        out: list[bytes] = [b""] * len(texts)
        odd = {i: texts[i].decode() for i, x in enumerate(texts) if _odd(x)}
        for i, x in odd.items():
            out[i] = self.ids([x])[0] if "<|" in x else np.asarray(self.fast.encode_ordinary(x), "<u4").tobytes()
        rest = [i for i, x in enumerate(texts) if x and i not in odd]
        if rest:
            for i, ids in zip(rest, self.regular([texts[i] for i in rest]), strict=True):
                out[i] = ids
        return out


@functools.cache
def encoder(path: str) -> Encoder:
    """One for each Python worker, which tasks share."""
    return Encoder(path)


def pieces(n: int, length: int) -> Iterator[tuple[int, int]]:
    """(start, length) of n tokens' binary pieces, long ones first."""
    at, size = 0, length
    while n:
        while size > n:
            size >>= 1
        yield at, size
        at, n = at + size, n - size


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, end: int = END) -> DataFrame:
    """docs (doc_id, text, ...): one row per piece (doc_id, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset, bucket).

    The ids of a document and ``end`` are split into pieces whose lengths are powers of two, ``length`` at most: as
    many of ``length`` as fit, then one for each bit set in the rest. A piece is a sequence of its own, so
    that no sequence crosses documents; batches are drawn from one bucket (log2 of the length), in which all
    sequences have the same length, a power of two, and none is padded. No shuffle is needed:
    sequence_id is the place of a piece in the scan, which a task run again gives again.
    Defined cases: null text is an empty one (one piece of one id); rows that share a doc_id, and null ids, are packed row by row; other
    columns are not read.
    """
    if length & (length - 1):
        raise ValueError("length must be a power of two")
    tokenizer = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, tail = encoder(tokenizer), end.to_bytes(4, "little")
        for b in slices(batches, most=3 << 20):
            rows: list[tuple] = []
            for i, x in zip(b["doc_id"].to_pylist(), coder.encode([x or b"" for x in b["text"].to_pylist()]), strict=True):
                x += tail
                for at, n in pieces(len(x) // 4, length):
                    ids = x[4 * at : 4 * (at + n)]
                    rows.append((i, at, n, ids, zlib.crc32(ids), len(x) // 4, n.bit_length() - 1))
            names = ("doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "bucket")
            kinds = (b["doc_id"].type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=list(names))

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"doc_id {kind}, start long, length long, ids binary, ids_crc32 long, doc_tokens long, bucket int")
    return out.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket")
