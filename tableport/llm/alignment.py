"""Alignment of the tokens of two tokenizers over the bytes of a text, and counts of linked ids.

A single space between two other characters always parts tokens of both tokenizers, so a text falls apart into chunks
that are aligned once per task and kept in a table. The offsets of the ``tokenizers`` encoding (characters) and the
spans of the sentencepiece proto (bytes) are the coarse cuts; tokens of parts of a character, byte-fallback pieces and
trimmed spaces are placed by the bytes they decode to.
"""

from __future__ import annotations

import re
from array import array

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.names import fresh
from ..session import materialize
from .common import give_back, quoted, small_batches, sub_batches, with_fields, without, written
from .pieces import MARK, chunkable

_CUT = re.compile(r"(?<=\S) (?=\S)")


def load_tokenizer(path: str) -> str:
    """The JSON of a byte-level tokenizer; a vocabulary, so of bounded size. Sent to the tasks with the code."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in a byte-level vocabulary: itself where printable, else the next from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """Both tokenizers with the bytes of their ids."""

    def __init__(self, a_json: str, b_model: bytes):
        import os

        import numpy as np

        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # a task has one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True              # their strings in a text are ordinary text
        self.b = SentencePieceProcessor(model_proto=b_model)
        signs = byte_signs()
        self.a_bytes = [b""] * (max(self.a.get_vocab().values()) + 1)
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(signs[c] for c in token) if all(c in signs for c in token) else token.encode()
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(MARK, " ").encode())
        self.a_sizes = np.array([len(b) for b in self.a_bytes], "i8")
        self.b_sizes = np.array([len(b) for b in self.b_bytes], "i8")

    def ends(self, text: str):
        """(A ids, their byte ends, B ids, their byte ends) over a space and the text; None if the bytes differ."""
        import numpy as np

        spaced = " " + text
        whole = spaced.encode()
        encoded = self.a.encode(spaced, add_special_tokens=False)
        a_ids = encoded.ids
        offsets = encoded.offsets
        proto = self.b.encode(text, return_type="proto")
        pieces = [(p.id, p.end) for p in proto.pieces]
        b_ids = [i for i, _ in pieces]
        if (b"".join(map(self.a_bytes.__getitem__, a_ids)) != whole
                or b"".join(map(self.b_bytes.__getitem__, b_ids)) != whole):
            return None
        a_ids, b_ids = np.array(a_ids, "i8"), np.array(b_ids, "i8")
        a_ends = np.fromiter((end for _, end in offsets), "i8", len(a_ids))
        if len(whole) != len(spaced):                    # characters to bytes
            points = np.frombuffer(spaced.encode("utf-32-le"), "u4")
            wide = 1 + (points > 0x7F).astype("i8") + (points > 0x7FF) + (points > 0xFFFF)
            a_ends = np.concatenate(([0], np.cumsum(wide)))[a_ends]
        b_ends = np.fromiter((end for _, end in pieces), "i8", len(b_ids)) + 1
        return (a_ids, self._refined(a_ends, a_ids, self.a_sizes), b_ids, self._refined(b_ends, b_ids, self.b_sizes))

    @staticmethod
    def _refined(ends, ids, sizes):
        """Coarse ends, those within characters and spaces moved to where the decoded bytes end."""
        import numpy as np

        decoded = np.cumsum(sizes[ids])
        return np.where(ends == decoded, ends, decoded)


class AlignedChunks:
    """Alignments of the distinct chunks met. When it grows too large, chunks met once go; that costs time only."""

    def __init__(self, pair: Pair, max_chunks: int = 300_000, max_chars: int = 6_000_000):
        import numpy as np

        self.pair, self.max_chunks, self.max_chars = pair, max_chunks, max_chars
        # each id as text with what follows it: nothing, another one of its tokenizer, the other side, the next group
        self.a_text, self.b_text = (
            [np.array([f"{i}{sign}" for i in range(len(ids))], object) for sign in signs]
            for ids, signs in ((pair.a_bytes, ",|"), (pair.b_bytes, (",", ";", ""))))
        self.clear()

    def clear(self):
        self.codes, self.chars, self.groups, self.odd = {}, 0, [], set()
        self.counts, self.first, self.links, self.met = array("q"), array("q", [0]), array("q"), array("q")

    def full(self) -> bool:
        return len(self.codes) > self.max_chunks or self.chars > self.max_chars

    def trim(self) -> None:
        """Keeps the chunks met most often, half of the table at most."""
        import numpy as np

        met, times, chunks = np.frombuffer(self.met, "i8"), 2, list(self.codes)
        sizes = np.fromiter(map(len, chunks), "i8", len(chunks))
        while np.count_nonzero(met >= times) > self.max_chunks // 2 or sizes[met >= times].sum() > self.max_chars // 2:
            times *= 2
        kept = np.flatnonzero(met >= times)
        counts, first = np.frombuffer(self.counts, "i8").reshape(-1, 4)[kept], np.frombuffer(self.first, "i8")[kept]
        n = counts[:, 3]
        links = np.frombuffer(self.links, "i8")[np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)]
        groups, odd = [self.groups[i] for i in kept], [i for i, k in enumerate(kept) if int(k) in self.odd]
        self.clear()
        self.codes = {chunks[k]: i for i, k in enumerate(kept)}
        self.chars, self.groups, self.odd = int(sizes[kept].sum()), groups, set(odd)
        self.counts.frombytes(counts.tobytes())
        self.first.frombytes(np.cumsum(n).astype("i8").tobytes())
        self.links.frombytes(links.tobytes())
        self.met.frombytes(np.ones(len(kept), "i8").tobytes())

    def _put(self, chunks: list[str], stops, found) -> None:
        """Adds chunks from the token ends over all of them, joined by single spaces; None for one that differs."""
        import numpy as np

        for chunk in chunks:
            self.codes[chunk] = len(self.codes)
            self.chars += len(chunk)
        self.met.extend([0] * len(chunks))
        if found is None:
            self.odd.add(len(self.groups))
            self.counts.extend((0, 0, 0, 0))
            self.first.append(len(self.links))
            self.groups.append("")
            return
        a_ids, a_ends, b_ids, b_ends = found
        both = np.sort(np.concatenate((a_ends, b_ends)), kind="stable")
        again = both[1:] == both[:-1]
        cuts = both[1:][again]                           # where tokens of both end
        parts = both[np.append(True, ~again)]            # each part lies in one A and one B token: a link
        links = (a_ids[np.searchsorted(a_ends, parts)] << 32) | b_ids[np.searchsorted(b_ends, parts)]
        upto = [np.searchsorted(x, stops, "right") for x in (a_ends, b_ends, cuts, parts)]
        a_to, b_to = (np.searchsorted(x, cuts, "right") for x in (a_ends, b_ends))
        a_out, b_out = self.a_text[0][a_ids], self.b_text[0][b_ids]
        a_out[a_to - 1], b_out[b_to - 1] = self.a_text[1][a_ids[a_to - 1]], self.b_text[1][b_ids[b_to - 1]]
        b_out[upto[1] - 1] = self.b_text[2][b_ids[upto[1] - 1]]
        # tokens in the order of groups, those of A first
        order = np.argsort(np.concatenate((np.searchsorted(cuts, a_ends) * 2, np.searchsorted(cuts, b_ends) * 2 + 1)), kind="stable")
        written, start = np.concatenate((a_out, b_out))[order].tolist(), 0
        for stop in (upto[0] + upto[1]).tolist():
            self.groups.append("".join(written[start:stop]))
            start = stop
        self.counts.frombytes(np.diff(np.stack(upto, 1), axis=0, prepend=0).astype("i8").tobytes())
        self.first.frombytes((len(self.links) + upto[3]).astype("i8").tobytes())
        self.links.frombytes(links.tobytes())

    def add(self, chunks) -> None:
        """Chunks that begin and end with other characters than white space are encoded together, the rest alone."""
        import numpy as np

        plain, others = [], []
        for chunk in chunks:
            (plain if chunk.strip() == chunk != "" and MARK not in chunk else others).append(chunk)
        for lo in range(0, len(plain), 5_000):
            some = plain[lo:lo + 5_000]
            found = self.pair.ends(" ".join(some))
            stops = np.cumsum(np.fromiter(map(len, map(str.encode, some)), "i8", len(some)) + 1)
            if found is not None and all((ends[np.searchsorted(ends, stops)] == stops).all() for ends in (found[1], found[3])):
                self._put(some, stops, found)
            else:
                others += some
        for chunk in others:
            self._put([chunk], np.array([len(chunk.encode()) + 1]), self.pair.ends(chunk))

    def code(self, texts: list[str]) -> list[list[int]]:
        """The chunk numbers of each text; none for an empty text and one whose tokens do not give its bytes."""
        import numpy as np

        split = [_CUT.split(t) if t else [] for t in texts]
        new, codes = set(), self.codes
        for chunks in split:
            new.update(set(chunks).difference(codes))
        self.add(new)
        rows = [list(map(codes.__getitem__, chunks)) for chunks in split]
        if self.odd:
            for i, row in enumerate(rows):
                if not self.odd.isdisjoint(row):
                    if texts[i] not in codes:
                        self.add([texts[i]])
                    rows[i] = [] if codes[texts[i]] in self.odd else [codes[texts[i]]]
        np.add.at(np.frombuffer(self.met, "i8"), [c for row in rows for c in row], 1)
        return rows


def align_texts(docs: DataFrame, a_json: str, b_model: bytes, text: str = "text", batch_bytes: int = 1_000_000) -> DataFrame:
    """``docs`` with ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``, ``groups`` (string) and ``links`` (array of long).

    A space and the text are encoded by the byte-level tokenizer A, the text by the sentencepiece model B, which adds the
    space; no special tokens. Byte places where tokens of both end cut them into groups, written ``a1,a2|b1;a3|b2``. A link
    is a pair of tokens whose bytes overlap, as ``A id << 32 | B id``, in text order. A text that is null or empty, or whose
    token bytes differ from it (the word marker itself in a text), has no tokens. Rows are independent; an empty table
    stays empty; columns named like a new one are replaced. Nothing is shuffled.
    """
    if not chunkable(b_model):
        raise ValueError("pieces of this model can cross whitespace markers")
    added = [("n_a", "bigint"), ("n_b", "bigint"), ("n_groups", "bigint"), ("n_links", "bigint"), ("groups", "string"),
             ("links", "array<bigint>")]
    docs = without(docs, *[name for name, _ in added])
    schema = with_fields(docs.schema, *added)

    def align(batches):
        import numpy as np
        import pyarrow as pa

        table = AlignedChunks(Pair(a_json, b_model))
        for whole in batches:
            for batch in sub_batches(whole, text, batch_bytes):
                if table.full():
                    table.trim()
                rows = table.code([t or "" for t in batch.column(text).to_pylist()])
                sizes = np.array([len(r) for r in rows], "i8")
                flat = np.fromiter((c for row in rows for c in row), "i8", int(sizes.sum()))
                before = np.concatenate(([0], np.cumsum(sizes)))
                counts = np.frombuffer(table.counts, "i8").reshape(-1, 4)[flat]
                sums = np.concatenate((np.zeros((1, 4), "i8"), np.cumsum(counts, axis=0)))[before]
                totals = np.diff(sums, axis=0)
                first, n = np.frombuffer(table.first, "i8")[flat], counts[:, 3]
                places = np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)
                links = np.frombuffer(table.links, "i8")[places]
                groups = [";".join(map(table.groups.__getitem__, row)) for row in rows]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *[pa.array(totals[:, i]) for i in range(4)], pa.array(groups, pa.string()),
                     pa.ListArray.from_arrays(pa.array(sums[:, 3].astype("i4")), pa.array(links))],
                    names=[f.name for f in schema])
                del counts, sums, totals, first, n, links, places, rows, flat, groups, batch
            del whole
            give_back()

    return docs.mapInArrow(align, schema)


def link_counts(aligned: DataFrame) -> DataFrame:
    """(link, n, best): how many links of the corpus hold the id pair, and whether no pair of its B id has more."""

    def count(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            links = batch.column("links").flatten().to_numpy(zero_copy_only=False)
            for lo in range(0, len(links), 2_000_000):
                found, n = np.unique(links[lo:lo + 2_000_000], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["link", "n"])

    counted = aligned.select("links").mapInArrow(count, "link bigint, n bigint").groupBy("link").agg(F.sum("n").alias("n"))
    counted = materialize(counted, "link-counts")
    b = F.col("link").bitwiseAND(0xFFFFFFFF)
    highest = counted.groupBy(b.alias("b")).agg(F.max("n").alias("most"))      # at most one row per id of B
    return materialize(counted.withColumn("b", b).join(highest, "b").select("link", "n", (F.col("n") == F.col("most")).alias("best")),
                       "link-best")


def score_links(aligned: DataFrame, max_broadcast: int = 1 << 20) -> DataFrame:
    """``aligned`` without ``links``, with ``n_best`` (links that are the commonest of their B id) and ``count_sum``.

    The counts of at most ``max_broadcast`` pairs (17 MB for 2^20), the most frequent ones, go to every task; links of
    other pairs, which are rare by that, are looked up by a join. Rows without links get zeros.
    """
    spark = aligned.sparkSession
    aligned = without(aligned, "n_best", "count_sum")
    row, best, total, rare = fresh(aligned.columns, "_row", "_best", "_total", "_rare")
    with small_batches(spark):
        aligned = written(aligned.withColumn(row, F.monotonically_increasing_id()), "aligned")
        counts = link_counts(aligned)
    level = F.floor(F.log2("n") * 8)
    held, least = 0, None
    for at, pairs in sorted(map(tuple, counts.groupBy(level.alias("level")).count().collect()), reverse=True):
        if held + pairs > max_broadcast:
            break
        held, least = held + pairs, at
    frequent = counts.where(level >= least if least is not None else F.lit(False)).toArrow()
    known = spark.sparkContext.broadcast(tuple(frequent.column(c).to_numpy() for c in ("link", "n", "best")))
    kept = [f for f in aligned.schema.fields if f.name != "links"]
    schema = with_fields(T.StructType(kept), (best, "bigint"), (total, "bigint"), (rare, "array<bigint>"))

    def look_up(batches):
        import numpy as np
        import pandas as pd
        import pyarrow as pa

        links, n, top = known.value
        index = pd.Index(links)
        n, top = np.append(n, 0), np.append(top, False).astype("i8")      # the last place is for unknown links
        for batch in batches:
            lists = batch.column("links")
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            stops = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
            at = index.get_indexer(flat)
            sums = [np.diff(np.concatenate(([0], np.cumsum(x[at])))[stops]) for x in (top, n)]
            missing = at < 0
            offsets = np.concatenate(([0], np.cumsum(missing)))[stops].astype("i4")
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in kept], *map(pa.array, sums),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat[missing]))], names=schema.names)
            del lists, flat, at, missing, batch
            give_back()

    with small_batches(spark):
        scored = materialize(aligned.mapInArrow(look_up, schema), "scored")
    others = scored.select(F.col(row).alias("own"), F.explode(rare).alias("link")).groupBy("own", "link").agg(F.count(F.lit(1)).alias("times"))
    others = others.join(counts, "link").groupBy("own").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more"))
    return scored.join(others, scored[row] == others["own"], "left").select(
        *[F.col(quoted(f.name)) for f in kept if f.name != row],
        (F.col(best) + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col(total) + F.coalesce("more", F.lit(0))).alias("count_sum"))
