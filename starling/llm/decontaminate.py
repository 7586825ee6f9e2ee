"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

Texts and items are sequences of words (runs of letters and digits, lower-cased; in scripts
written without spaces every character is a word).
A document is contaminated by an item if some passage of it is within an edit
distance of ``MAX_EDITS`` times the item's words (words inserted, deleted or
replaced).

*Embedding.*  The CGK random walk (Chakraborty, Goldenberg, Koucky, 2016) reads a
sequence with one pointer: step *j* writes the word under the pointer, and a random
bit that depends on *j* and that word says whether the pointer moves on.  Two
sequences walked with the same bits fall back into step after an edit, so a small
edit distance becomes a small Hamming distance of the written words.

*LSH.*  For each of ``TABLES`` walks the words written at ``SAMPLES`` random steps
make a key; equal keys are candidates.  A copy without edits always agrees; the
number of tables is set for the recall of copies with edits (measured in the tests).

*Windows.*  Items are dealt into classes of similar length.  For a class of at least
*n* words windows begin at every ``stride`` = n / 4 words of a text and are n - stride
words long; an item is entered once for each of its first ``stride`` words as the
beginning.  So every passage has a window that begins inside its first ``stride``
words, at a place where the item was entered, wherever the passage lies.

*Bound.*  A window within the distance holds at least its length less the edits of
words that occur in items; windows with fewer are not walked.  The bound is exact: no
window that could match is left out.

*Verification* is exact: the least edit distance between the item and any passage
around the window (Sellers' dynamic programme over words).

*Short items*, of fewer than ``MIN_WORDS`` words, allow no edit: they are looked up as exact
sequences.  ``drop_contaminated`` does not go by them, as a few words are no evidence
against a longer document.

Items are handled in blocks of at most ``BLOCK_WORDS`` words, each block broadcast and
held against all documents, so memory does not grow with the benchmark (a word of an item
takes about 0.45 windows, each 12 bytes a table: about 220 bytes).

Defined cases: null and empty texts hold nothing; an item without a word is found nowhere;
items of equal text each get their own rows; a document's repeated passage gives one row per item (least distance,
then first place); documents repeated give repeated rows; no items, no rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, unused

MAX_EDITS = 0.2
MIN_WORDS = 5
TABLES = 40
SAMPLES = 4
CLASS_FACTOR = 1.5
SEED = 2016
BLOCK_WORDS = 500_000
#: Texts searched together (their words lie in one array).
TEXTS_AT_ONCE = 512
#: Windows walked at once.
WALK_ROWS = 1 << 14

#: Blocks of scripts written without spaces (Thai and Lao, Burmese, Khmer, kana, Han characters).
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_ANY_UNSPACED = re.compile(f"[{_UNSPACED}]")
_WORD = re.compile(r"[^\W_]+")
_WORD_OR_CHARACTER = re.compile(rf"[{_UNSPACED}]|(?:(?![{_UNSPACED}])[^\W_])+")


def folded(text: str | None) -> str:
    """The text in lower case, character by character: places stay those of the text."""
    text = text or ""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower()[0] for c in text)


def _pattern(low: str) -> re.Pattern:
    return _WORD if low.isascii() or not _ANY_UNSPACED.search(low) else _WORD_OR_CHARACTER


def words_of(text: str | None) -> list[str]:
    low = folded(text)
    return _pattern(low).findall(low)


def word_places(text: str | None) -> list[tuple[int, int]]:
    low = folded(text)
    return [m.span() for m in _pattern(low).finditer(low)]


def passage_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance between ``item`` and any passage of ``text``, with the passage's begin and end."""
    n = len(text)
    cost = np.zeros(n + 1, np.int64)
    begin = np.arange(n + 1)
    steps = np.arange(n + 1)
    for k, word in enumerate(item):
        # Replace or keep, or leave the item's word out.
        take = cost[:-1] + (text != word)
        skip = cost + 1
        new = skip.copy()
        new_begin = begin.copy()
        better = take < new[1:]
        new[1:][better] = take[better]
        new_begin[1:][better] = begin[:-1][better]
        # Extra words of the text: a running minimum of cost minus place.
        key = new - steps
        low = np.minimum.accumulate(key)
        from_here = key == low
        source = np.maximum.accumulate(np.where(from_here, steps, 0))
        cost = low + steps
        begin = new_begin[source]
    end = int(cost.argmin())
    return int(cost[end]), int(begin[end]), end


@dataclass
class LengthClass:
    least: int
    stride: int
    window: int
    needed: int
    #: per table and step: with a word's code it says whether the pointer moves on
    salt: np.ndarray
    at: np.ndarray
    #: which words the items of this class have
    known: np.ndarray
    #: (item, offset) of every window that was entered
    owner: np.ndarray | None = None
    #: per table: sorted keys and, for each, its window's number
    keys: list[np.ndarray] = field(default_factory=list)
    entries: list[np.ndarray] = field(default_factory=list)


class Index:
    """The items of one block: vocabulary, walks and tables."""

    def __init__(self, items: list[tuple[object, str]], tables: int = TABLES, samples: int = SAMPLES,
                 max_edits: float = MAX_EDITS, short: bool = True):
        """``short``: also look up items of fewer than ``MIN_WORDS`` words."""
        self.max_edits = max_edits
        by_words: dict[tuple[str, ...], list] = defaultdict(list)
        for item_id, text in items:
            found = tuple(words_of(text))
            if len(found) >= (1 if short else MIN_WORDS):
                by_words[found].append(item_id)
        self.item_ids = list(by_words.values())
        self.vocabulary: dict[str, int] = {}
        self.items = [np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in ws], np.int32)
                      for ws in by_words]
        self.classes: list[LengthClass] = []
        #: For each length of short items: their sorted keys, and which items these are.
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        rng = np.random.default_rng(SEED)
        if not self.items:
            return
        # One random number per word: whichever words are in the block, a word's bits stay its own.
        code = np.zeros(len(self.vocabulary) + 1, np.uint64)
        from xxhash import xxh64_intdigest
        # Words of no item share a code; it moves the pointer as any other does, so a walk gets past them.
        code[0] = xxh64_intdigest("", SEED)
        for w, k in self.vocabulary.items():
            code[k] = xxh64_intdigest(w, SEED)
        self.mix = rng.integers(1, 1 << 63, samples, dtype=np.uint64) | np.uint64(1)
        self.code = code
        lengths = np.array([len(x) for x in self.items])
        for n in range(1, MIN_WORDS):
            mine = np.flatnonzero(lengths == n)
            if len(mine):
                keys = self._sequence_keys(np.stack([self.items[i] for i in mine]).T)
                order = np.argsort(keys, kind="stable")
                self.short[n] = keys[order], mine[order]
        long = lengths[lengths >= MIN_WORDS]
        least = int(long.min()) if len(long) else 1
        while len(long) and least <= lengths.max():
            top = max(least + 1, int(np.ceil(least * CLASS_FACTOR)))
            mine = np.flatnonzero((lengths >= least) & (lengths < top))
            if len(mine):
                self.classes.append(self._enter(int(lengths[mine].min()), mine, tables, samples, max_edits, rng))
            least = top

    def _enter(self, least: int, mine: np.ndarray, tables: int, samples: int, max_edits: float,
               rng: np.random.Generator) -> LengthClass:
        stride = max(1, least // 4)
        window = least - stride
        # Edits of the longest item may all fall into its window.
        longest = max(len(self.items[i]) for i in mine)
        needed = max(1, window - int(self.max_edits * longest))
        steps = window
        salt = rng.integers(1, 1 << 63, (tables, steps), dtype=np.uint64) | np.uint64(1)
        at = np.stack([np.sort(rng.choice(steps, min(samples, steps), replace=False)) for _ in range(tables)])
        in_class = np.zeros(len(self.vocabulary) + 1, bool)
        in_class[np.concatenate([self.items[i] for i in mine])] = True
        c = LengthClass(least, stride, window, needed, salt, at, in_class)
        heads, owner = [], []
        for i in mine:
            # Words missing from a passage's beginning move its window's place in the item further on.
            for o in range(min(stride + int(max_edits * longest), len(self.items[i]) - 1)):
                heads.append(self.items[i][o:o + window])
                owner.append((i, o))
        # A head cut short by its item's end is filled up with the code of unknown words.
        flat = np.zeros((len(heads) + 1, window + 1), np.int32)
        for k, h in enumerate(heads):
            flat[k, :len(h)] = h
        begins = np.arange(len(heads)) * (window + 1)
        flat = flat.ravel()
        c.owner = np.array(owner, np.int32)
        for t in range(tables):
            k = self._walk(c, t, flat, begins)
            order = np.argsort(k, kind="stable")
            c.keys.append(k[order])
            c.entries.append(order.astype(np.int32))
        return c

    def _walk(self, c: LengthClass, table: int, words: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """The key of the window of ``c.window`` words at each of ``begins``."""
        pointer = begins.astype(np.int32)
        key = np.zeros(len(begins), np.uint64)
        salt, at = c.salt[table], c.at[table]
        which = 0
        # After j steps the pointer is at most j words on, so it stays inside the window.
        for j in range(int(at[-1]) + 1):
            code = self.code[words[pointer]]
            if j == at[which]:
                key = (key ^ code) * self.mix[which]
                key ^= key >> np.uint64(31)
                which += 1
            code *= salt[j]
            pointer += ((code >> np.uint64(61)) & np.uint64(1)).astype(np.int32)
        return key

    def _sequence_keys(self, words: np.ndarray) -> np.ndarray:
        """A key for each sequence of words, given as its first words, its second words, and so on."""
        key = np.zeros(len(words[0]), np.uint64)
        for w in words:
            key = (key ^ self.code[w]) * self.mix[0]
            key ^= key >> np.uint64(29)
        return key

    def _short_places(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """(text, item, place) of the first place of each short item in each text; places as in ``words``."""
        out = []
        for n, (keys, mine) in self.short.items():
            shifted = [words[j:len(words) - n + 1 + j] for j in range(n)]
            # The places where all words occur in items.
            places = np.flatnonzero(np.logical_and.reduce([w > 0 for w in shifted]))
            key = self._sequence_keys(np.stack([w[places] for w in shifted]))
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            item = mine[at]
            sequences = np.stack([self.items[i] for i in mine])
            same = np.logical_and.reduce([sequences[at, j] == shifted[j][places] for j in range(n)])
            places, item = places[same], item[same]
            text = np.searchsorted(starts, places, "right") - 1
            # Of each text and item the first: places are in order, and unique keeps the first.
            _, first = np.unique(text * len(self.items) + item, return_index=True)
            out.append(np.stack([text[first], item[first], places[first]], axis=1))
        return np.concatenate(out) if out else np.zeros((0, 3), np.int64)

    def join(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Encoded texts in one array, far enough apart that no window reaches the next; and where each begins."""
        gap = np.zeros(max([MIN_WORDS, *(c.window for c in self.classes)]) + 1, np.int32)
        begins = np.concatenate([[0], np.cumsum([len(t) + len(gap) for t in texts])]).astype(np.int64)
        return np.concatenate([x for t in texts for x in (t, gap)]) if texts else gap, begins

    def _candidates(self, words: np.ndarray) -> np.ndarray:
        """Distinct (item, place) whose keys agree in some table."""
        out = []
        for c in self.classes:
            known = np.concatenate([[0], np.cumsum(c.known[words])])
            begins = np.arange(0, len(words) - c.window, c.stride)  # the last gap holds no window's beginning
            ends = begins + c.window
            begins = begins[known[ends] - known[begins] >= c.needed]
            for at in range(0, len(begins), WALK_ROWS):
                part = begins[at:at + WALK_ROWS]
                for t in range(len(c.keys)):
                    key = self._walk(c, t, words, part)
                    lo = np.searchsorted(c.keys[t], key, "left")
                    inside = lo < len(c.keys[t])
                    inside[inside] = c.keys[t][lo[inside]] == key[inside]
                    hit = np.flatnonzero(inside)
                    if not len(hit):
                        continue
                    n = np.searchsorted(c.keys[t], key[hit], "right") - lo[hit]
                    which = np.repeat(lo[hit], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    entry = c.owner[c.entries[t][which]]
                    out.append(np.stack([entry[:, 0], np.repeat(part[hit], n) - entry[:, 1]], axis=1))
        if not out:
            return np.zeros((0, 2), np.int64)
        found = np.unique(np.concatenate(out), axis=0)
        return np.concatenate([self._may_match(words, int(i), found[found[:, 0] == i]) for i in np.unique(found[:, 0])])

    def _may_match(self, words: np.ndarray, i: int, found: np.ndarray) -> np.ndarray:
        """The places around which enough words of the item occur: all but ``most`` of its words must."""
        item = self.items[i]
        most = int(self.max_edits * len(item))
        member = np.zeros(len(self.vocabulary) + 1, bool)
        member[item] = True
        around = np.arange(-2 * most, len(item) + 2 * most)
        keep = np.zeros(len(found), bool)
        for at in range(0, len(found), WALK_ROWS):
            place = np.clip(found[at:at + WALK_ROWS, 1, None] + around, 0, len(words) - 1)
            keep[at:at + WALK_ROWS] = member[words[place]].sum(axis=1) >= len(item) - most
        return found[keep]

    def search(self, texts: list[np.ndarray]) -> list[dict[int, tuple[int, int, int]]]:
        """For each encoded text {item: (distance, begin, end)} of its passages within the distance, in words."""
        words, starts = self.join(texts)
        found: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
        present = np.zeros(len(self.vocabulary) + 1, bool)
        for k, i, p in self._short_places(words, starts).tolist():
            at = p - int(starts[k])
            found[k][i] = (0, at, at + len(self.items[i]))
        for i, p in self._candidates(words).tolist():
            item = self.items[i]
            most = int(self.max_edits * len(item))
            # The place lies in its text, or up to the edits before it.
            k = int(np.searchsorted(starts, max(p, 0) + most, "right")) - 1
            k = min(k, len(texts) - 1)
            if p < starts[k] and k and p + len(item) // 2 < starts[k]:
                k -= 1
            text, mine = texts[k], found[k]
            at = p - int(starts[k])
            if i in mine and mine[i][0] == 0:
                continue
            if at >= 0 and np.array_equal(text[at:at + len(item)], item):
                mine[i] = (0, at, at + len(item))
                continue
            slack = 2 * most
            a, b = max(0, at - slack), min(len(text), at + len(item) + slack)
            part = text[a:b]
            # At least all but ``most`` of the item's words must be there.
            present[part] = True
            there = np.count_nonzero(present[item])
            present[part] = False
            if there < len(item) - most:
                continue
            d, x, y = passage_distance(item, part)
            if d <= most and (i not in mine or (d, a + x) < mine[i][:2]):
                mine[i] = (d, a + x, a + y)
        return found

    def encode(self, found: list[str]) -> np.ndarray:
        get = self.vocabulary.get
        return np.fromiter((get(w, 0) for w in found), np.int32, len(found))


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[object, str]]]:
    """The items in blocks, by a hash of the id; each block is collected on its own."""
    items = benchmark.select("item_id", "text").filter(F.col("text").isNotNull())
    # At least as many as there are words: runs without white space, and every character of unspaced scripts.
    unspaced = F.length(F.regexp_replace("text", f"[^{_UNSPACED}]", ""))
    total = items.agg(F.sum(F.size(F.split("text", r"[^\p{L}\p{N}]+")) + unspaced)).first()[0] or 0
    n = max(1, -(-total // block_words))
    for k in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield [(r[0], r[1]) for r in part.collect()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS,
               block_words: int = BLOCK_WORDS, short: bool = True) -> DataFrame:
    """(doc_id, item_id, n_edits, start, end): the passages of ``docs`` within reach of an item.

    Places are code points of the text; end exclusive.  ``short``: also look for items of
    fewer than ``MIN_WORDS`` words, which have to be there without edits.
    """
    spark = docs.sparkSession
    ship_package(spark)
    narrow = docs.select("doc_id", "text")
    doc_kind = narrow.schema["doc_id"].dataType.simpleString()
    item_type = benchmark.schema["item_id"].dataType
    schema = f"doc_id {doc_kind}, item_id {item_type.simpleString()}, n_edits int, `start` bigint, `end` bigint"
    out = None
    for items in _blocks(benchmark, block_words):
        index = spark.sparkContext.broadcast(Index(items, max_edits=max_edits, short=short))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            ix = index.value
            for batch in batches:
                rows = []
                for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                    texts = batch.column(1).slice(at, TEXTS_AT_ONCE).to_pylist()
                    for k, hits in enumerate(ix.search([ix.encode(words_of(t)) for t in texts])):
                        if not hits:
                            continue
                        spots = word_places(texts[k])
                        for i, (d, a, b) in sorted(hits.items()):
                            rows += [(at + k, item_id, d, spots[a][0], spots[b - 1][1]) for item_id in ix.item_ids[i]]
                cols = list(zip(*rows)) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], item_arrow), pa.array(cols[2], pa.int32()),
                     pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                    ["doc_id", "item_id", "n_edits", "start", "end"])

        item_arrow = _arrow_type(item_type)
        part = narrow.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def _arrow_type(kind):
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a passage of an item of ``MIN_WORDS`` words or more.

    A document is told by its doc_id (null matches null) and its text, so one that is clean
    stays even if it shares its id with one that is not.
    """
    leak, key = unused(docs, "leak_id", "leak_key")
    who = F.struct("doc_id", F.xxhash64("text").alias("text_key"))
    leaks = find_leaks(docs.select(who.alias("doc_id"), "text"), benchmark, short=False).select(
        F.col("doc_id.doc_id").alias(leak), F.col("doc_id.text_key").alias(key)).distinct()
    same = docs["doc_id"].eqNullSafe(leaks[leak]) & (F.xxhash64(docs["text"]) == leaks[key])
    return docs.join(leaks, same, "left_anti")


def leaks_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return find_leaks(docs, benchmark)
