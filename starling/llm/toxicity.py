"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

*Features* of a whole text (``FEATURES``): densities of two lexicons (a written-out one, ``INSULTS``, and
one of words and word beginnings learned from labels), how near their words stand to a second person,
shares of capitals, marks and symbols, and rates of obfuscation: look-alike characters inside a word
("1d1ot"), letters set apart ("i d i o t", "i.d.i.o.t"), letters repeated ("idiooot"); such words are
also looked up after they have been put back.

*Learning.*  Labelled documents are halved by a hash of their id.  One half gives the learned lexicon:
words, and beginnings that several words of a text share, over-represented in toxic texts, by the
log-likelihood ratio of their document counts (Spark aggregates; at most ``LEXICON_CANDIDATES`` reach the
driver, which keeps those that neither begin nor continue a better one).  The other half, at most
``TRAIN_ROWS`` rows (a documented bound), is turned into features on the executors, and numpy fits the
trees to binned features by second-order gradients.  Fold by fold, trees that have not seen a row score it,
and pooling adjacent violators over these scores gives the calibration.

*Scoring.*  Whole texts, batch by batch in the tasks; nothing but the model is broadcast
(``TREES`` trees and ``LEXICON_WORDS`` beginnings of words, whatever the corpus).

Defined cases: null and empty texts are scored from features that are all zero; with no label, or
labels of one kind only, the score is the constant share of label 1 (0.5 without any); labels repeated
for a document count once, the largest; rows that repeat an id each get their own text's score, a null
id is never learned from and never held out; further columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship_package

TRAIN_ROWS = 8000
LEXICON_WORDS = 300
LEXICON_CANDIDATES = 5000
#: Lengths of the word beginnings that are tried.
STEMS = (3, 4, 5, 6, 7, 8)
#: A word is learned from a ratio of so much (twice the log-likelihood ratio) and so many toxic texts.
LEAST_RATIO = 24.0
LEAST_TEXTS = 4
NEAR = 4
TREES = 60
DEPTH = 3
RATE = 0.15
BINS = 32
FOLDS = 4
DECAY = 1.0
LEAST_HESSIAN = 1.0
CUT = 0.7

#: Insults of four languages, and the words of the second person.
INSULTS = frozenset("""
idiot idiots moron morons stupid scum trash loser losers worthless pathetic disgusting clown clowns fool fools dumb imbecile
jerk bastard garbage vermin
dumm dummkopf trottel abschaum blödmann vollidiot widerlich erbärmlich
imbécile crétin ordure débile pathétique dégoûtant minable
idiota imbécil estúpido estúpida basura escoria patético asqueroso payaso
""".split())
SECOND_PERSON = frozenset("""
you your yours yourself ur u du dich dir dein deine deiner ihr euch euer tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros tus
""".split())

FEATURES = ("log_words", "insults", "insult_density", "insult_kinds", "learned", "learned_density", "learned_weight", "put_back",
            "near_person", "near_share", "persons", "capitals", "capital_words", "exclaims", "questions", "marks", "symbols",
            "digits", "mixed_words", "spaced_words", "long_letters")

_WORD = re.compile(r"[^\W\d_]+")
#: Letters, look-alikes and single separators between them; possessive, so a text is read once.
_TOKEN = re.compile(r"[\w@$]++(?:[.*\-][\w@$]++)*+")
_SPACED = re.compile(r"(?<!\w)(?:[^\W\d_][ .\-_*]){3,40}[^\W\d_](?!\w)")
_LONG = re.compile(r"([^\W\d_])\1{2,}")
_CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]+")
_CAPITAL_WORD = re.compile(r"(?<!\w)[A-ZÀ-ÖØ-Þ]{2,}(?!\w)")
_MARKS = re.compile(r"[.,;:!?]+")
_SYMBOLS = re.compile(r"[#*$%&|<>@^~=+/\\]+")
_DIGITS = re.compile(r"[0-9]+")
#: Characters that stand for letters.
_LOOKS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"})
_APART = re.compile(r"[ *_.\-]+")


def put_back(word: str) -> str:
    """The word without look-alikes, separators and letters repeated more than twice."""
    return _LONG.sub(r"\1", _APART.sub("", word).translate(_LOOKS))


class Lexicon:
    """Learned beginnings of words with their weights; remembers up to ``MEMORY`` words it was asked for."""

    MEMORY = 200_000

    def __init__(self, stems: dict[str, float]):
        self.stems = stems
        self.known: dict[str, float] = {}

    def weight(self, word: str) -> float:
        """The largest weight of a beginning of the word, or the whole; 0 without any."""
        w = self.known.get(word)
        if w is None:
            if len(self.known) >= self.MEMORY:
                self.known.clear()
            found = [self.stems[word[:k]] for k in STEMS if k <= len(word) and word[:k] in self.stems]
            if f"{word} " in self.stems:  # a whole word is learned with a blank behind it
                found.append(self.stems[f"{word} "])
            w = self.known[word] = max(found, default=0.0)
        return w


def _inside(letters: str) -> bool:
    """Do letters that stood apart spell an insult, somewhere among them."""
    return any(letters[i:i + k] in INSULTS for i in range(len(letters)) for k in range(4, 13))


def text_features(text: str, lexicon: Lexicon) -> list[float]:
    """The numbers ``FEATURES`` of one whole text."""
    if not text:
        return [0.0] * len(FEATURES)
    size = len(text)
    lower = text.lower()
    words = _WORD.findall(lower)
    n = max(len(words), 1)
    insults = [k for k, w in enumerate(words) if w in INSULTS]
    weights = [lexicon.weight(w) for w in words] if lexicon.stems else []
    found = [k for k, w in enumerate(weights) if w]
    persons = [k for k, w in enumerate(words) if w in SECOND_PERSON]
    mixed = [w for w in _TOKEN.findall(lower) if not w.isalpha() and _WORD.search(w)]
    spaced = [m.group() for m in _SPACED.finditer(lower)]
    long = [w for w in words if _LONG.search(w)] if _LONG.search(lower) else []
    back = sum(1 for w in (*mixed, *long) if (b := put_back(w)) in INSULTS or lexicon.weight(b)) + sum(_inside(put_back(w)) for w in spaced)
    hits = sorted({*insults, *found})
    near = 0
    if hits and persons:
        at = np.searchsorted(persons, hits)
        p = np.array(persons)
        left = np.where(at > 0, np.array(hits) - p[np.maximum(at - 1, 0)], NEAR + 1)
        right = np.where(at < len(p), p[np.minimum(at, len(p) - 1)] - np.array(hits), NEAR + 1)
        near = int((np.minimum(left, right) <= NEAR).sum())

    def share(pattern: re.Pattern) -> float:
        return 100.0 * sum(map(len, pattern.findall(text))) / size

    return [float(np.log1p(len(words))), float(len(insults)), 100.0 * len(insults) / n, float(len({words[k] for k in insults})),
            float(len(found)), 100.0 * len(found) / n, sum(weights[k] for k in found), float(back),
            float(near), near / max(len(hits), 1), 100.0 * len(persons) / n,
            share(_CAPITALS), 100.0 * len(_CAPITAL_WORD.findall(text)) / n, 100.0 * text.count("!") / size,
            100.0 * text.count("?") / size, share(_MARKS), share(_SYMBOLS), share(_DIGITS),
            100.0 * len(mixed) / n, 100.0 * len(spaced) / n, 100.0 * len(long) / n]


def _matrix(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """One row of features for each text; one text at a time is a Python string."""
    out = np.zeros((len(texts), len(FEATURES)))
    for k, t in enumerate(texts):
        out[k] = text_features(t.as_py() or "", lexicon)
    return out


@dataclass
class Tree:
    """A full binary tree: node k has children 2k+1 and 2k+2; leaves hold values."""
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[np.arange(len(x)), self.feature[node]] > self.cut[node])
        return self.value[node]


def _grow(binned: np.ndarray, edges: list[np.ndarray], grad: np.ndarray, hess: np.ndarray) -> Tree:
    """The tree whose splits lower the second-order loss the most, level by level."""
    nodes = 2 ** (DEPTH + 1) - 1
    feature, cut, value = np.zeros(nodes, np.int64), np.full(nodes, np.inf), np.zeros(nodes)
    node = np.zeros(len(grad), np.int64)
    for k in range(nodes):
        rows = np.flatnonzero(node == k)
        g, h = grad[rows].sum(), hess[rows].sum()
        value[k] = -g / (h + DECAY)
        if k >= 2 ** DEPTH - 1:
            continue
        best, at = 1e-9, None
        for f in range(binned.shape[1]):
            gl = np.bincount(binned[rows, f], grad[rows], BINS).cumsum()[:-1]
            hl = np.bincount(binned[rows, f], hess[rows], BINS).cumsum()[:-1]
            gain = gl ** 2 / (hl + DECAY) + (g - gl) ** 2 / (h - hl + DECAY) - g * g / (h + DECAY)
            gain[(hl < LEAST_HESSIAN) | (h - hl < LEAST_HESSIAN)] = 0
            b = int(gain.argmax())
            if gain[b] > best and b < len(edges[f]):
                best, at = gain[b], (f, b)
        right = np.zeros(len(rows), bool)
        if at is not None:
            feature[k], cut[k] = at[0], edges[at[0]][at[1]]
            right = binned[rows, at[0]] > at[1]
        node[rows] = 2 * k + 1 + right
    return Tree(feature, cut, value)


def boost(x: np.ndarray, y: np.ndarray) -> tuple[float, list[Tree]]:
    """Trees of the logistic loss, each fitted to the gradients that the others leave."""
    edges = [np.unique(np.quantile(x[:, f], np.arange(1, BINS) / BINS)) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    share = min(max(y.mean(), 1e-6), 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    logit, trees = np.full(len(y), base), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-logit))
        tree = _grow(binned, edges, p - y, p * (1 - p))
        trees.append(tree)
        logit += RATE * tree.predict(x)
    return base, trees


def margins(x: np.ndarray, base: float, trees: list[Tree]) -> np.ndarray:
    out = np.full(len(x), base)
    for t in trees:
        out += RATE * t.predict(x)
    return out


def isotonic(scores: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the middles of the blocks and their shares, both increasing.

    Equal scores are one block from the outset.
    """
    at, inverse = np.unique(scores, return_inverse=True)
    count = np.bincount(inverse).astype(float)
    blocks: list[list[float]] = []  # lowest score, highest score, rows, sum of labels
    for s, n, t in zip(at, count, np.bincount(inverse, y)):
        blocks.append([s, s, n, t])
        while len(blocks) > 1 and blocks[-2][3] * blocks[-1][2] >= blocks[-1][3] * blocks[-2][2]:
            top = blocks.pop()
            blocks[-1] = [blocks[-1][0], top[1], blocks[-1][2] + top[2], blocks[-1][3] + top[3]]
    # A block's share is drawn towards one half by one row, so that a few rows never say "surely".
    return (np.array([v for b in blocks for v in (b[0], b[1])]),
            np.maximum.accumulate(np.array([v for b in blocks for v in 2 * [(b[3] + 0.5) / (b[2] + 1)]])))


@dataclass
class Model:
    learned: dict[str, float]
    base: float
    trees: list[Tree]
    steps: np.ndarray
    shares: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(margins(x, self.base, self.trees), self.steps, self.shares)


def constant(share: float) -> Model:
    return Model({}, 0.0, [], np.zeros(1), np.array([share]))


def fit(x: np.ndarray, y: np.ndarray, learned: dict[str, float]) -> Model:
    fold = np.arange(len(y)) % FOLDS  # rows come in the order of a hash
    unseen = np.zeros(len(y))
    for k in range(FOLDS):
        own = fold == k
        unseen[own] = margins(x[own], *boost(x[~own], y[~own])) if own.any() and (~own).any() else 0.0
    base, trees = boost(x, y)
    return Model(learned, base, trees, *isotonic(unseen, y))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn_lexicon(texts: DataFrame) -> dict[str, float]:
    """Beginnings of words over-represented in the toxic ones of ``texts`` (text, y), with the logarithm of how much.

    Equal texts count once, so that copies of one text don't make its words significant.
    """
    texts = texts.filter(F.col("text").isNotNull()).groupBy(F.xxhash64("text").alias("h"), "text").agg(F.max("y").alias("y"))
    found = texts.select("h", "y", F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("whole")).filter("whole <> ''")
    stems = F.filter(F.array(*[F.when(F.length("whole") >= k, F.substring("whole", 1, k)) for k in STEMS], F.concat("whole", F.lit(" "))),
                     lambda x: x.isNotNull())
    found = found.select("h", "y", F.explode(stems).alias("word")).groupBy("h", "y", "word").agg(F.count(F.lit(1)).alias("c"))
    # A whole word counts by itself; a beginning where a text has two words or more with it.
    found = found.filter((F.col("c") > 1) | F.endswith("word", F.lit(" "))).select("y", "word")
    totals = texts.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("p")).first()
    n, p = totals["n"], totals["p"] or 0
    if not p or p == n:
        return {}
    counts = found.groupBy("word").agg(F.count(F.lit(1)).alias("w"), F.sum("y").alias("t")).filter(F.col("t") >= LEAST_TEXTS)
    share = p / n

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    w, t = F.col("w"), F.col("t")
    ratio = 2 * (part(t, w * share) + part(w - t, w * (1 - share)))
    best = (counts.filter(t > w * share).select("word", ratio.alias("ratio"), F.log((t / p) / ((w - t + 0.5) / (n - p + 1))).alias("more"))
            .filter(F.col("ratio") >= LEAST_RATIO).orderBy(F.col("ratio").desc(), F.length("word"), "word").limit(LEXICON_CANDIDATES))
    out: dict[str, float] = {}
    begun: set[str] = set()  # all beginnings of those kept
    for r in best.collect():
        stem = r["word"]
        if stem in begun or any(stem[:k] in out for k in range(1, len(stem))):
            continue
        out[stem] = float(r["more"])
        begun.update(stem[:k] for k in range(1, len(stem) + 1))
        if len(out) == LEXICON_WORDS:
            break
    return out


def learn(docs: DataFrame, labels: DataFrame, learn_from: Column, rows: int = TRAIN_ROWS) -> Model:
    """A model from ``labels`` (doc_id, toxic) for which ``learn_from`` (over doc_id) holds."""
    ship_package(docs.sparkSession)
    known = (labels.filter(learn_from & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("y")))
    turn = F.xxhash64(F.lit("toxicity"), F.col("doc_id"))
    total = known.count()
    # About twice ``rows`` labels, half of them for the lexicon; a bounded number that is broadcast.
    some = known.filter(F.abs(F.shiftright(turn, 1) % 1_000_000) < 2_000_000.0 * rows / max(total, 1))
    some = some.orderBy(turn).limit(2 * rows).select("doc_id", "y", (F.pmod(turn, F.lit(2)) == 0).alias("lexical"))
    rows_of = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")
    learned = learn_lexicon(rows_of.filter("lexical"))
    shared = docs.sparkSession.sparkContext.broadcast(learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(shared.value)
        for batch in batches:
            x = _matrix(batch.column(2), lexicon)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r.tobytes() for r in x], pa.binary())],
                                             ["turn", "y", "x"])

    fitting = rows_of.filter(~F.col("lexical")).select(F.xxhash64("doc_id", "text").alias("turn"), "y", "text")
    # Rows, not ids, are bounded: an id may repeat.
    got = fitting.mapInArrow(run, "turn bigint, y int, x binary").orderBy("turn", "y", "x").limit(rows).collect()
    y = np.array([r["y"] for r in got], float)
    if not len(y) or y.min() == y.max():
        return constant(float(y.mean()) if len(y) else 0.5)
    return fit(np.stack([np.frombuffer(r["x"]) for r in got]), y, learned)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""
    spark = docs.sparkSession
    ship_package(spark)
    narrow = docs.select("doc_id", "text")
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        lexicon = Lexicon(m.learned)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(m.score(_matrix(batch.column(1), lexicon)), pa.float64())],
                                             ["doc_id", "score"])

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, score double")


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = learn(docs, labels, ~held_out(F.col("doc_id")))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                     (F.col("score") >= CUT).cast("int").alias("predicted"))
