"""SentencePiece encoding and decoding through tables of distinct chunks.

The library turns each space into the marker U+2581 and puts one marker before the text. Where no piece
of the vocabulary holds a marker behind another character, a piece cannot cross from a word into the
marker after it, so a text falls apart into chunks (a run of markers and the characters up to the next
run) that are segmented independently. Each task keeps a table of the distinct chunks it has met; a chunk
is segmented and decoded once, and the ids of a text are gathered from the table by position.
"""

from __future__ import annotations

import re
from array import array

from pyspark.sql import DataFrame, functions as F

from .common import give_back, quoted, sub_batches, with_fields, without

MARK = "▁"
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")


def load_model(path: str) -> bytes:
    """The model file; a vocabulary, so of bounded size. Sent to the tasks with the code."""
    with open(path, "rb") as file:
        return file.read()


def _processor(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def chunkable(model: bytes) -> bool:
    """Whether no piece holds a marker behind another character."""
    processor = _processor(model)
    return all(MARK not in processor.id_to_piece(i).lstrip(MARK) for i in range(processor.get_piece_size()))


class ChunkTable:
    """Distinct chunks with their ids and their decoded text; starts anew when it grows too large.

    Starting anew costs time only: every chunk is segmented by the library in any case.
    """

    def __init__(self, model: bytes, max_chunks: int = 100_000, max_chars: int = 8_000_000):
        self.processor = _processor(model)
        self.max_chunks, self.max_chars = max_chunks, max_chars
        self.clear()

    def clear(self):
        self.codes, self.chars = {}, 0
        self.starts, self.lengths, self.flat, self.decoded = array("q"), array("q"), array("i"), []

    def full(self) -> bool:
        return len(self.codes) > self.max_chunks or self.chars > self.max_chars

    def _add(self, chunks: list[str]):
        # encode() puts the first marker itself, but gives nothing for an empty text
        ids = self.processor.encode([c[1:] for c in chunks], num_threads=1)
        lone = self.processor.piece_to_id(MARK)
        ids = [i if c != MARK else [lone] for i, c in zip(ids, chunks)]
        # a sentinel piece in front keeps decode() from dropping the leading marker
        sentinel = self.processor.encode("a")
        lead = len(self.processor.decode(sentinel))
        texts = self.processor.decode([sentinel + i for i in ids])
        for chunk, own, text in zip(chunks, ids, texts):
            self.starts.append(len(self.flat))
            self.lengths.append(len(own))
            self.flat.extend(own)
            self.decoded.append(text[lead:])
            self.chars += len(chunk)

    def code(self, texts: list[str]) -> list[array]:
        """The chunk numbers of each text; new chunks are segmented together."""
        codes, known, fresh, out = self.codes, len(self.decoded), [], []
        for text in texts:
            marked = text.replace(" ", MARK)
            if not text:
                chunks = []
            elif MARK + MARK in marked or marked[0] == MARK or marked[-1] == MARK:
                chunks = _CHUNK.findall(MARK + marked)
            else:
                chunks = [MARK + word for word in marked.split(MARK)]
            row = array("q")
            for chunk in chunks:
                at = codes.get(chunk)
                if at is None:
                    at = codes[chunk] = known + len(fresh)
                    fresh.append(chunk)
                row.append(at)
            out.append(row)
        if fresh:
            self._add(fresh)
        return out

    def ids_of(self, codes: list[array], eos: bool):
        """Flat ids of all texts and the offsets of each text in them."""
        import numpy as np

        starts, lengths = np.frombuffer(self.starts, "i8"), np.frombuffer(self.lengths, "i8")
        flat = np.frombuffer(self.flat, "i4")
        end, rows = [self.processor.eos_id()] if eos else [], []
        for row in codes:
            if not row:
                rows.append(np.array(end, "i4"))
                continue
            at = np.frombuffer(row, "i8")
            n = lengths[at]
            before = np.concatenate(([0], np.cumsum(n)))
            places = np.arange(before[-1]) + np.repeat(starts[at] - before[:-1], n)
            rows.append(np.concatenate((flat[places], np.array(end, "i4"))))
        offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype("i4")
        return (np.concatenate(rows) if rows else np.zeros(0, "i4")), offsets

    def text_of(self, row: array) -> str:
        text = "".join(map(self.decoded.__getitem__, row))
        return text[1:] if text.startswith(" ") else text  # decode() drops the marker before the text


def encode_texts(docs: DataFrame, model: bytes, text: str = "text", eos: bool = True,
                 batch_bytes: int = 2_000_000) -> DataFrame:
    """``docs`` with ``ids`` (array of int, as the library's ``encode``) and ``decoded`` (its ``decode`` of them).

    A null text counts as empty: only the end id, decoded to an empty text. Rows are independent, so ties
    and repeated rows get equal results; an empty table stays empty; columns of ``docs`` named like a new
    one are replaced. A model whose pieces can cross a marker is refused. Nothing is shuffled.
    """
    if not chunkable(model):
        raise ValueError("pieces of this model can cross whitespace markers")
    docs = without(docs, "ids", "decoded")
    schema = with_fields(docs.schema, ("ids", "array<int>"), ("decoded", "string"))

    def encode(batches):
        import pyarrow as pa

        table = ChunkTable(model)
        for whole in batches:
            for batch in sub_batches(whole, text, batch_bytes):
                if table.full():
                    table.clear()
                codes = table.code([t or "" for t in batch.column(text).to_pylist()])
                flat, offsets = table.ids_of(codes, eos)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                decoded = pa.array([table.text_of(row) for row in codes], pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns, ids, decoded], names=[f.name for f in schema])
                del codes, flat, offsets, ids, decoded, batch
            del whole
            give_back()

    return docs.mapInArrow(encode, schema)


def with_digests(encoded: DataFrame) -> DataFrame:
    """Number of ids and SHA-256 of the ids (decimal, one space between) and of the decoded text."""
    encoded = without(encoded, "n_tokens", "ids_sha256", "decoded_sha256")
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        *[F.col(quoted(c)) for c in encoded.columns if c not in ("ids", "decoded")],
        F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
