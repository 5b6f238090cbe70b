"""SentencePiece encoding and decoding: a single-pass Viterbi driven by an Aho-Corasick automaton over the pieces."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, worker_cache

#: What stands for a space inside pieces.
MARK = "▁"
#: How much less than the least piece a character without a piece scores.
UNKNOWN_PENALTY = 10.0
#: Stretches between marks whose pieces a worker remembers.
REMEMBERED = 300_000
STRETCH = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """Encoder and decoder over a model's pieces and scores.

    Encoding maximises the sum of the pieces' scores; on ties the longer last piece stands. A character without a piece of
    its own becomes its UTF-8 bytes, each a piece. No piece holds a mark after another character, so that the stretches
    that begin with marks are encoded each on its own and remembered.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.names = [model.id_to_piece(i) for i in range(n)]
        self.bytes_of = {i: int(self.names[i][3:5], 16) for i in range(n) if model.is_byte(i)}
        self.byte_ids = {b: i for i, b in self.bytes_of.items()}
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        if any(MARK in self.names[i].lstrip(MARK) for i in plain):
            raise ValueError("a piece holds a space after another character")
        self.unknown = min(model.get_score(i) for i in plain) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for i in plain:
            self.automaton.add_word(self.names[i], (i, len(self.names[i]), model.get_score(i)))
        self.automaton.make_automaton()
        self.known: dict[str, bytes] = {}
        self.surface = [bytes([self.bytes_of[i]]) if i in self.bytes_of else self.names[i].replace(MARK, " ").encode() for i in range(n)]
        for i in range(n):
            if model.is_control(i):
                self.surface[i] = b""

    def viterbi(self, text: str) -> list[int]:
        """One pass over the automaton's matches: at each place, the output links give the pieces that end there, the
        longest first."""
        best, back = [0.0] + [float("-inf")] * len(text), [(0, -1)] * (len(text) + 1)
        done, single = 0, False

        def unknowns(upto: int) -> None:
            """Relaxes places by the character alone."""
            nonlocal done, single
            while done < upto:
                if not single and best[done] + self.unknown > best[done + 1]:
                    best[done + 1], back[done + 1] = best[done] + self.unknown, (done, -1)
                done, single = done + 1, False

        for end, (piece, length, score) in self.automaton.iter(text):
            unknowns(end)
            single |= length == 1
            value = best[end + 1 - length] + score
            if value > best[end + 1]:
                best[end + 1], back[end + 1] = value, (end + 1 - length, piece)
        unknowns(len(text))
        out, at = [], len(text)
        while at:
            start, piece = back[at]
            out += [piece] if piece >= 0 else [self.byte_ids[b] for b in reversed(text[start:at].encode("utf-8", "replace"))]
            at = start
        return out[::-1]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers. A mark is put before the text, and marks for its spaces."""
        if not text:
            return b""
        stretches = STRETCH.findall(MARK + text.replace(" ", MARK))
        if len(self.known) > REMEMBERED:
            self.known = {}
        known = self.known
        for s in set(stretches):
            if s not in known:
                known[s] = np.array(self.viterbi(s), "<u4").tobytes()
        return b"".join([known[s] for s in stretches])

    def decode(self, ids: bytes) -> str:
        """The text of ids; the mark before it goes. Bytes that aren't UTF-8 become the replacement character."""
        surface = self.surface
        text = b"".join([surface[i] for i in np.frombuffer(ids, "<u4").tolist()])
        return text[text[:1] == b" " :].decode("utf-8", "replace")


def pieces(path: str) -> Pieces:
    return worker_cache(f"pieces {path}", lambda: Pieces(path))


def encoded(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, ids) of every row of docs (doc_id, text): ids as little-endian unsigned 32-bit numbers. A null text has null
    ids, an empty one none. Other columns are ignored."""
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [None if t is None else pieces(path).encode(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids binary")


def decoded(rows: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, ids, text) of rows (doc_id, ids): the text that ids stand for; null ids have a null text. Spaces come back
    as they were, and so does all other text but the mark itself, which becomes a space."""
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [None if x is None else pieces(path).decode(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    small_batches(rows.sparkSession)
    return rows.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def query(spark, sf_dir: str) -> DataFrame:
    """Of each document: how many pieces, the checksum of their ids, and the hash of the text decoded from them."""
    rows = decoded(encoded(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return rows.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"), F.sha2("text", 256).alias("text_sha256"))
