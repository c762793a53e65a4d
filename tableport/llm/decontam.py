"""Benchmark passages in training documents.

Word n-grams of the test items that are rare in the corpus are the seeds: among every few neighbouring n-grams of an
item the one with the fewest occurrences is taken, so any run of ``n + window - 1`` words an edited copy keeps holds a
seed, however common its item is. So does any n-gram that few items share, and any three of four neighbouring words that
few items share, for copies whose kept runs are shorter. A seed joins a passage of a document to an item; Smith-Waterman alignment of the
words around it with the item gives the score. An excerpt too short for the score but long in itself is found by a second
alignment in which an edited word costs as much as four kept ones give.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import give_back, quoted, sub_batches, without

N, WINDOW = 3, 3
SHAPES = ((0, 1, 2), (0, 1, 3), (0, 2, 3))               # words of an n-gram, and of four words without one
FEW = 16                                                 # items that may share a seed which is not the rarest around
MATCH, MISMATCH, GAP = 2, -1, -1
EDIT = -4                                                # of an excerpt; a kept word is 1
_WORD = re.compile(r"\w+")


# bytes of Latin-1 that are not part of a word, as spaces
_LATIN = bytes(c if _WORD.fullmatch(chr(c)) else 32 for c in range(256))
_BETWEEN = b"."                                          # no word


def raw_words(text: str | None) -> bytes:
    """The words of ``words_of`` with spaces between, in Latin-1; other signs as ``&#n;``, which no word holds."""
    low = (text or "").lower()
    try:
        return low.encode("latin-1").translate(_LATIN)
    except UnicodeEncodeError:
        return " ".join(_WORD.findall(low)).encode("latin-1", "xmlcharrefreplace")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def local_alignment(item, passage, match=MATCH, mismatch=MISMATCH, gap=GAP) -> tuple[int, int]:
    """Smith-Waterman over words: (best score, place in ``passage`` where it ends). Linear gaps; a row at a time, gaps
    along the row by a running maximum."""
    steps = np.arange(1, len(passage) + 1) * -gap
    row, best, end = np.zeros(len(passage), "i8"), 0, 0
    for word in item:
        diagonal = np.concatenate(([0], row[:-1])) + np.where(passage == word, match, mismatch)
        cell = np.maximum(np.maximum(diagonal, row + gap), 0)
        row = np.maximum.accumulate(cell + steps) - steps
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
    return best, end


class Sieve:
    """Bits by hash of sorted numbers, 16 or more for each: most that are not among them fail here."""

    def __init__(self, known):
        self.known, self.shift = known, np.uint64(64 - max(10, (16 * len(known)).bit_length()))
        self.bits = np.zeros(1 << (64 - int(self.shift)), bool)
        self.bits[self.place(known)] = True

    def place(self, numbers):
        return (numbers.view("u8") * np.uint64(_ODD)) >> self.shift


_ODD = 0x9E3779B97F4A7C15                                # odd 64-bit multiplier


def _matches(sieve, grams):
    """Where ``grams`` holds one of the sieve's numbers, and which one."""
    known = sieve.known
    if not len(known):
        return np.zeros(0, "i8"), np.zeros(0, "i8")
    candidates = np.flatnonzero(sieve.bits[sieve.place(grams)] & (grams >= 0))
    at = np.searchsorted(known, grams[candidates])
    hit = known[np.minimum(at, len(known) - 1)] == grams[candidates]
    return candidates[hit], at[hit]


def _seed_table(grams, rarest=None):
    """Seeds as (n-grams, start of each one's holders, items, places): those in few items, and the ``rarest`` places."""
    items = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    places = np.concatenate([np.zeros(0, "i8"), *[np.arange(len(g)) for g in grams]]).astype("i8")
    flat = np.concatenate([np.zeros(0, "i8"), *grams])
    _, number = np.unique(flat, return_inverse=True)
    holders = np.bincount(np.unique(np.stack((number, items)), axis=1)[0]) if len(flat) else np.zeros(0, "i8")
    keep = holders[number] <= FEW
    if rarest is not None:
        keep |= np.array([p in rarest[i] for i, p in zip(items.tolist(), places.tolist())], bool)
    flat, items, places = flat[keep], items[keep], places[keep]
    order = np.argsort(flat, kind="stable")
    seeds, starts = np.unique(flat[order], return_index=True)
    return Sieve(seeds), np.append(starts, len(flat)), items[order], places[order]


class Items:
    """A block of test items with their words as numbers and their n-grams as one number each."""

    def __init__(self, rows):
        self.ids, texts = [r[0] for r in rows], [words_of(r[1]) for r in rows]
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
        self.words = [np.array([self.vocabulary[w] for w in t], "i8") for t in texts]
        self.base = len(self.vocabulary) + 1
        self.flags = np.zeros(self.base, bool)
        if self.base ** N >= 1 << 62:
            raise ValueError("too many different words in one block of items")
        self.grams = [self.grams_of(w) for w in self.words]
        self.known = np.unique(np.concatenate([np.zeros(0, "i8"), *self.grams]))
        self.sieve = Sieve(self.known)
        self.codes = {w.encode("latin-1", "xmlcharrefreplace"): i for w, i in self.vocabulary.items()} | {_BETWEEN: -2}

    def grams_of(self, words, shape=SHAPES[0]):
        size = len(words) - shape[-1]
        if size < 1:
            return np.zeros(0, "i8")
        out = np.zeros(size, "i8")
        for i in shape:
            part = words[i:size + i]
            out = np.where((part < 0) | (out < 0), -1, out * self.base + part)
        return out

    def numbered_texts(self, texts):
        """(numbers, starts) of the words of many texts in one array; one number below zero between two texts, so no n-gram spans them."""
        found = (b" " + _BETWEEN + b" ").join(map(raw_words, texts)).split()
        words = np.fromiter(map(self.codes.get, found, repeat(-1)), "i8", len(found))
        return words, np.concatenate(([0], np.flatnonzero(words == -2) + 1, [len(words) + 1]))

    def known_places(self, grams):
        """Where ``grams`` holds an n-gram of an item, and which one."""
        return _matches(self.sieve, grams)

    def seed(self, counts):
        """Seeds from the corpus counts of ``known``: {index of the n-gram: [(item, place in it)]}."""
        rarest = []
        for item, grams in enumerate(self.grams):
            at, chosen = np.searchsorted(self.known, grams), set()
            for start in range(max(1, len(at) - WINDOW + 1) if len(at) else 0):
                near = range(start, min(start + WINDOW, len(at)))
                chosen.add(min(near, key=lambda p: (counts[at[p]], at[p], p)))
            rarest.append(chosen)
        skipping = [[self.grams_of(w, shape) for w in self.words] for shape in SHAPES[1:]]
        self.tables = [_seed_table(self.grams, rarest), *map(_seed_table, skipping)]
        return self

    def search_texts(self, texts, min_score: float, min_excerpt: int):
        """(place of the text, item id, score, end word) of the items found in texts; only texts with a seed are looked at alone."""
        words, starts = self.numbered_texts(texts)
        seeded = [_matches(table[0], self.grams_of(words, shape))[0] for shape, table in zip(SHAPES, self.tables)]
        for at in np.unique(np.searchsorted(starts, np.concatenate(seeded), "right") - 1).tolist():
            for item, score, end in self.search(words[starts[at]:starts[at + 1] - 1], min_score, min_excerpt):
                yield at, item, score, end

    def search(self, words, min_score: float, min_excerpt: int):
        """(item id, score from 0 to 1, number of the word where it ends) of the items found in the words of a text."""
        all_grams, seeded = self.grams_of(words), []
        for shape, (grams, starts, items, owns) in zip(SHAPES, self.tables):
            there = all_grams if shape is SHAPES[0] else self.grams_of(words, shape)
            places, which = _matches(grams, there)
            many = starts[which + 1] - starts[which]
            at = np.repeat(starts[which] - np.cumsum(many) + many, many) + np.arange(many.sum())
            seeded.append((items[at], np.repeat(places, many), owns[at]))
        items, places, owns = (np.concatenate(column) for column in zip(*seeded))
        order, windows = np.lexsort((owns, places, items)), {}
        for item, place, own in zip(items[order].tolist(), places[order].tolist(), owns[order].tolist()):
            size = len(self.words[item])
            begin, end = max(0, place - own - size), min(len(words), place - own + 2 * size)
            spans = windows.setdefault(item, [])
            if spans and begin <= spans[-1][1]:
                spans[-1][:] = min(begin, spans[-1][0]), max(end, spans[-1][1])
            else:
                spans.append([begin, end])
        for item, spans in sorted(windows.items()):
            own = self.words[item]
            least = min_score * MATCH * len(own)
            # too few of the item's words in the others for that score, or for that excerpt
            common = [self.common(own, words[begin:end]) for begin, end in spans]
            score, at = self.best_of(item, words, [s for s, n in zip(spans, common) if MATCH * n >= least])
            if score < least - 1e-9 or not score:
                long = [s for s, n in zip(spans, common) if n >= min_excerpt]
                if not self.has_excerpt(item, words, all_grams, long, min_excerpt):
                    continue
                score, at = self.best_of(item, words, spans)
            yield self.ids[item], round(score / (MATCH * len(own)), 6), int(at)

    def common(self, own, passage) -> int:
        """Words of an item that are somewhere in the passage."""
        self.flags[passage] = True                       # an unknown word, -1, flags the last place, which no word has
        count = np.count_nonzero(self.flags[own])
        self.flags[passage] = False
        return count

    def best_of(self, item: int, words, spans):
        best, at = 0, 0
        for begin, end in spans:
            score, place = local_alignment(self.words[item], words[begin:end])
            if score > best:
                best, at = score, begin + place
        return best, at

    def has_excerpt(self, item: int, words, grams, spans, least: int) -> bool:
        """Whether an alignment has ``least`` kept words more than ``-EDIT`` times its edited ones."""
        for begin, end in spans:
            # e edits leave at most e + 1 runs of least - EDIT * e words, each with N - 1 n-grams fewer than words
            if np.isin(grams[begin:max(begin, end - N + 1)], self.grams[item]).sum() <= least - N:
                continue
            if local_alignment(self.words[item], words[begin:end], 1, EDIT, EDIT)[0] >= least:
                return True
        return False


def item_blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int):
    """The test items in blocks of about ``block_bytes`` of text; a block is what is held at once and sent to tasks."""
    items = benchmark.select(F.col(quoted(item_id)).cast("long").alias("item"), F.col(quoted(text)).alias("text"))
    items = items.where(F.col("text").isNotNull()).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        if rows:
            yield Items(sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0], r[1])))


def corpus_counts(docs: DataFrame, items: Items, text: str = "text"):
    """Occurrences in all documents of each n-gram of a block."""
    def count(batches):
        import pyarrow as pa

        totals = np.zeros(len(items.known), "i8")
        for whole in batches:
            for batch in sub_batches(whole, text, 1_000_000):
                words, _ = items.numbered_texts(batch.column(0).to_pylist())
                _, which = items.known_places(items.grams_of(words))
                seen, n = np.unique(which, return_counts=True)
                totals[seen] += n
        seen = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(totals[seen])], names=["gram", "n"])
        give_back()

    counted = docs.select(F.col(quoted(text))).mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n"))
    counts = np.zeros(len(items.known), "i8")
    for gram, n in counted.collect():                    # one row per n-gram of the block
        counts[gram] = n
    return counts


def find_items(docs: DataFrame, benchmark: DataFrame, min_score: float = 0.5, item_id: str = "item_id",
               item_text: str = "text", text: str = "text", block_bytes: int = 4_000_000,
               min_excerpt: int = 13) -> DataFrame:
    """``docs`` with ``hits``: array of (item_id, score, end_word) of the test items found in the text.

    The score is the alignment's share of the score of a full copy (2 a match, -1 a mismatch or a gap), so 1 is a
    whole copy and 0.5 one with a third of its words replaced. A copy is looked at if it has a seed: five kept words in a
    row, or three of four neighbouring words that at most ``FEW`` items share. With a third of its words replaced or
    fewer, and none put in or left out, a copy of seven or more words has three of four; with words put in between
    every two or so, a copy of the same score may have none and is not found. An item is found if its score is ``min_score`` or more,
    or if the text has an excerpt of it: an alignment whose kept words are ``min_excerpt`` more than four times its
    edited ones (13 words as they are, 17 around an edited one), however small a share of the item that is. Words are compared in lower case, without punctuation.
    Only items of at least three words are looked for. Null and empty texts hold nothing; repeated rows get equal
    hits; repeated items count once; an empty table or benchmark gives no hits; a column named ``hits`` is replaced.

    The benchmark goes to the tasks in blocks of ``block_bytes``; a block costs one pass that counts its n-grams in
    the corpus and one that aligns. Documents are not shuffled, so a passage in a third of them makes no hot task.
    """
    found = without(docs, "hits").withColumn("hits", F.array().cast("array<struct<item_id:bigint,score:double,end_word:bigint>>"))
    for items in item_blocks(benchmark, item_id, item_text, block_bytes):
        items.seed(corpus_counts(docs, items, text))
        found = _search(found, items, text, min_score, min_excerpt)
    return found


def _search(docs: DataFrame, items: Items, text: str, min_score: float, min_excerpt: int) -> DataFrame:
    schema = docs.schema

    def search(batches):
        import pyarrow as pa

        for whole in batches:
            for batch in sub_batches(whole, text, 1_000_000):
                at = batch.schema.get_field_index("hits")
                kind, hits = batch.schema.field(at).type, batch.column(at).to_pylist()
                for own, i, s, e in items.search_texts(batch.column(text).to_pylist(), min_score, min_excerpt):
                    hits[own].append({"item_id": i, "score": s, "end_word": e})
                columns = [c if k != at else pa.array(hits, kind) for k, c in enumerate(batch.columns)]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])
        give_back()

    return docs.mapInArrow(search, schema)
