"""Personal data: exact base patterns, and a character BiLSTM-CRF that adds what they miss.

*Base.*  E-mail addresses, IP addresses, payment cards (Luhn) and phone numbers in their
plain forms, leftmost and non-overlapping per kind; a match that fails its check is
dropped without another try.

*Tagger.*  Trained in numpy from labelled spans: on windows of at most about
``TRAIN_TEXTS`` sampled texts (a documented bound) whose base spans are the labels, and
on the same contexts with written-out forms put in (``name at host dot org``,
``(212) 555-0100``, grouped digits, spaced addresses), labelled where they were put.

*Whole texts.*  The texts of a block lie in one stream, cut into windows of ``WINDOW``
characters that overlap by ``2 * MARGIN``.  Added spans must not touch base spans, must look
like their kind (enough digits, four groups, a host) and never cross texts.  Windows that
can hold no such span (too few digits, no @ or "dot" or bracketed "at" outside of base spans)
are not tagged: the bound is exact.  All others are tagged and decoded.  The parts of a span
that two neighbouring windows both cut are joined.  Then the spans of all windows are held
against each other: of two that overlap the one further from its window's edge stays, then
the longer one, then the first.

Defined cases: null and empty texts have no spans; repeated rows are each searched; a
table without any base span still trains on the written-out forms; an empty table gives
an empty result.  Places are code points, end exclusive.
"""

from __future__ import annotations

import bisect
import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import char_crf
from .common import ship_package

KINDS = ("email", "ip", "card", "phone")
WINDOW = 1024
MARGIN = 48
WINDOWS_AT_ONCE = 1024
TRAIN_TEXTS = 4000
PIECES = 5
TRAIN_LENGTH = 112
TRAIN_WINDOWS = 2400
EPOCHS = 10
RATE = 0.025

# The base patterns of the query contract.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS_AND_DOTS = re.compile(r"[0-9][0-9.]*")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if k % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ with its run of local characters: one step per character, however long the run."""
    done = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL_CHARS:
            begin -= 1
        m = _DOMAIN.match(text, at) if begin < at else None
        if m:
            yield begin, m.end()
            done = m.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """Base spans in order of start, then kind."""
    out: list[Span] = [(a, 0, b) for a, b in _emails(text)]
    for run in _DIGITS_AND_DOTS.finditer(text):
        if run.group().count(".") >= 3:
            for m in _IP.finditer(text, run.start(), run.end()):
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
                    out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = "".join(c for c in m.group() if c.isdigit())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


# --- training ---------------------------------------------------------------------------------


def _written_out(kind: int, rng: np.random.Generator) -> str:
    """A span of a kind in a form the base patterns do not know (or, for one in four, do)."""
    def digits(n: int) -> str:
        return "".join(rng.choice(list("0123456789"), n))

    def letters(a: int, b: int) -> str:
        return "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), int(rng.integers(a, b))))

    plain = rng.random() < 0.25
    if kind == 0:
        user = letters(3, 9) + ("" if rng.random() < 0.5 else "." + digits(2))
        host = [letters(3, 8), str(rng.choice(["com", "org", "net", "de", "example.com"]))]
        if plain:
            return user + "@" + ".".join(host)
        at, dot = [(" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" @ ", ".")][int(rng.integers(4))]
        return user + at + dot.join(host)
    if kind == 1:
        parts = [str(int(rng.integers(1, 256))) for _ in range(4)]
        return (("." if plain else str(rng.choice([" . ", ". ", " dot ", "[.]"])))).join(parts)
    if kind == 2:
        body = str(rng.choice(list("3456"))) + digits(14)
        check = next(c for c in "0123456789" if luhn(body + c))
        full = body + check
        sep = "" if plain else str(rng.choice([".", "  ", "/", "_"]))
        return sep.join(full[k:k + 4] for k in range(0, 16, 4))
    a, b, c = digits(3), digits(3), digits(4)
    if plain:
        return f"+{int(rng.integers(1, 99))} ({a}) {b}-{c}"
    return str(rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"00{int(rng.integers(1, 99))} {a} {b} {c}", f"{a}.{b}.{c}"]))


def training_windows(contexts: list[tuple[str, list[Span]]], n: int = TRAIN_WINDOWS, seed: int = 3):
    """Classes and tags (T, n): a third as they are, the rest with one or two written-out spans put in."""
    rng = np.random.default_rng(seed)
    plain = [("the house by the river was empty. Nobody came, not even in 2019, version 3.2 of it.", [])]
    contexts = contexts or plain
    marked = [c for c in contexts if c[1]]
    x = np.zeros((TRAIN_LENGTH, n), np.uint8)
    y = np.zeros((TRAIN_LENGTH, n), np.int8)
    for col in range(n):
        pool = marked if marked and rng.random() < 0.4 else contexts
        text, spans = pool[int(rng.integers(len(pool)))]
        tags = np.zeros(len(text), np.int8)
        for a, k, b in spans:
            tags[a:b] = 2 + 2 * k
            tags[a] = 1 + 2 * k
        if col % 3:
            for _ in range(int(rng.integers(1, 3))):
                kind = int(rng.integers(len(KINDS)))
                put = _written_out(kind, rng)
                free = [p for p in (m.start() for m in re.finditer(" ", text)) if not tags[p]]
                if not free:
                    break
                p = free[int(rng.integers(len(free)))]
                own = np.full(len(put), 2 + 2 * kind, np.int8)
                own[0] = 1 + 2 * kind
                text = text[:p + 1] + put + text[p:]
                tags = np.concatenate([tags[:p + 1], own, tags[p:]])
        begin = int(rng.integers(0, max(1, len(text) - TRAIN_LENGTH + 1)))
        while begin > 0 and tags[begin] and tags[begin] % 2 == 0:  # not in the middle of a span
            begin -= 1
        part = char_crf.classes_of(text)[begin:begin + TRAIN_LENGTH]
        x[:len(part), col] = part
        y[:len(part), col] = tags[begin:begin + TRAIN_LENGTH]
    return x, y


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of sampled texts: one around each base span (four a text at most), and one without."""
    side = TRAIN_LENGTH
    for batch in batches:
        rows = []
        for text in batch.column(0).to_pylist():
            text = text or ""
            spans = base_spans(text)
            cuts = [(max(0, a - side // 2), min(len(text), b + side // 2)) for a, _, b in spans[:4]]
            # Marks and digits that are no span teach more than plain prose.
            odd = re.search(r"[0-9#&@=]", text)
            mid = odd.start() if odd else len(text) // 2
            cuts.append((max(0, mid - side // 2), min(len(text), mid + side // 2)))
            for a, b in cuts:
                inside = [[s - a, k, e - a] for s, k, e in spans if s >= a and e <= b]
                cut = any(s < b and e > a and not (s >= a and e <= b) for s, _, e in spans)
                if not cut:
                    rows.append((text[a:b], [v for s in inside for v in s]))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()),
                                          pa.array([r[1] for r in rows], pa.list_(pa.int32()))], ["piece", "spans"])


def learn(docs: DataFrame, texts: int = TRAIN_TEXTS) -> char_crf.Tagger:
    """A tagger trained on contexts from about ``texts`` documents, chosen by a hash of id and text.

    At most ``PIECES`` different contexts a text are kept, whatever the ids and however often rows repeat.
    Training is one task on one thread (a worker has as many as its task has cores), which a lost
    executor's successor does again; only the tagger, a few thousand numbers, comes to the driver.
    """
    spark = docs.sparkSession
    ship_package(spark)
    total = docs.select("doc_id").count()
    chosen = F.abs(F.xxhash64(F.lit("pii"), F.col("doc_id"), F.col("text")) % 1_000_000) < 1_000_000.0 * texts / max(total, 1)
    pieces = docs.filter(chosen).select("text").mapInArrow(_contexts, "piece string, spans array<int>").distinct()
    pieces = pieces.orderBy(F.xxhash64("piece"), "piece", "spans").limit(PIECES * texts)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(r["piece"], r["spans"]) for batch in batches for r in batch.to_pylist()]
        contexts = sorted((t, [tuple(v[k:k + 3]) for k in range(0, len(v), 3)]) for t, v in rows)
        x, y = training_windows([c for c in contexts if c[0].strip()])
        model = char_crf.train(x, y, len(KINDS), EPOCHS, rate=RATE)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    found = pieces.coalesce(1).mapInArrow(fit, "model binary").collect()
    # No context at all, so perhaps no task: the written-out forms are enough to train on.
    return pickle.loads(found[0][0]) if found else char_crf.train(*training_windows([]), len(KINDS), EPOCHS, rate=RATE)


# --- tagging ----------------------------------------------------------------------------------

_HOST_CHARS = frozenset("abcdefghijklmnopqrstuvwxyz0123456789-")
_AT = re.compile(r"\s?[\[(]?\s?(@|at)")
_DOT = re.compile(r"\s?[\[(]?\s?(\.|dot)")
_SIGN_END = re.compile(r"\s?[\])]?\s?")
_MAIL_MARK = re.compile(r"@|dot|[(\[]at[)\]]")


def _is_host(host: str) -> bool:
    """Names of letters, digits and hyphens with ``.`` or ``dot`` between them, once at least.

    "dot" may be part of a name as well, so all readings are followed at once, place by place:
    at each place, can a reading that ends there be inside a name, and can a name begin there.
    """
    n = len(host)
    inside = [[False, False] for _ in range(n + 1)]  # a name ends here, without and with a dot before
    begins = [[False, False] for _ in range(n + 1)]
    begins[0][0] = True
    for at in range(n):
        if any(inside[at]):
            m = _DOT.match(host, at)
            if m:
                last = _SIGN_END.match(host, m.end()).end()
                for end in range(m.end(), min(last, n) + 1):
                    begins[end][1] = True
        if host[at] in _HOST_CHARS:
            for dotted in (0, 1):
                inside[at + 1][dotted] |= inside[at][dotted] or begins[at][dotted]
    return inside[n][1]


def _ascii_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _plausible(kind: int, found: str) -> bool:
    """What a span of a kind has at least; ``_live`` relies on it."""
    if kind == 0:
        low = found.lower()
        return bool(_MAIL_MARK.search(low)) and any(_is_host(low[end:]) for end in _heads(low))
    digits = _ascii_digits(found)
    if kind == 1:
        parts = re.findall(r"[0-9]+", found)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 7 <= len(digits) <= 15 and not re.search(r"[A-Za-z]", found)


def _heads(low: str) -> list[int]:
    """Where a host may begin after a name and its ``@`` or ``at``."""
    name = re.match(r"[a-z0-9._%+-]+", low)
    if not name:
        return []
    ends = []
    # "at" inside the name's own run of characters, or the sign right after the run.
    for m in re.finditer(r"at", name.group()):
        if m.start() and low[m.end():m.end() + 1]:
            ends.append(m.end())
    after = _AT.match(low, name.end())
    if after:
        ends.append(after.end())
    out = []
    for end in ends:
        last = _SIGN_END.match(low, end).end()
        out += range(end, last + 1)
    return out


def _live(stream: np.ndarray, covered: np.ndarray, n: int, step: int) -> np.ndarray:
    """Which of the ``n`` windows can hold a span that ``_plausible`` lets pass, or a part of one: an exact bound.

    Outside of base spans (``covered``), which added spans never touch, such a span has an ``@``, a "dot" or
    a bracketed "at", or at least seven digits, or four groups of them.  As a span may be joined from the parts
    of two neighbouring windows, a window is judged together with its neighbours.
    """
    code = char_crf.classes_of

    def word(*letters: np.ndarray) -> np.ndarray:
        there = np.ones(len(stream), bool)
        for j, c in enumerate(letters):
            there[:len(stream) - j] &= (stream[j:] == c[0]) if len(c) == 1 else np.isin(stream[j:], c)
            there[len(stream) - j:] = False
        return there

    marks = word(code("@")) | word(code("d"), code("o"), code("t")) | word(code("(["), code("a"), code("t"), code(")]"))
    marks &= ~covered
    digits = (stream == code("0")[0]) & ~covered
    groups = digits.copy()
    groups[1:] &= ~digits[:-1]
    begins = np.maximum(np.arange(n) * step - step, 0)
    ends = np.minimum(np.arange(n) * step + WINDOW + step, len(stream))
    begins = np.minimum(begins, ends)

    def inside(places: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(places)
        return np.searchsorted(at, ends) - np.searchsorted(at, begins)

    # The first of four groups may have begun before the window.
    return (inside(marks) > 0) | (inside(digits) >= 7) | (inside(groups) >= 3)


def _clear(taken: list[Span], s: Span) -> bool:
    """Does ``s`` overlap none of ``taken``, which are in order and overlap none of each other."""
    k = bisect.bisect_left(taken, s)
    return (k == len(taken) or taken[k][0] >= s[2]) and (k == 0 or taken[k - 1][2] <= s[0])


def _trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    while a < b and text[a].isspace():
        a += 1
    while a < b and text[b - 1] in " \t\n,;":
        b -= 1
    return a, b


def stream_spans(tagger: char_crf.Tagger, stream: np.ndarray, covered: np.ndarray | None = None,
                 accept=lambda s: s) -> list[Span]:
    """Spans over one stream of classes, windows reconciled: each span once.

    Windows that can hold no plausible span clear of ``covered`` (base spans) are not tagged; without
    ``covered`` all are.  ``accept`` gives a span's final form or None, before spans of neighbouring windows
    are held against each other.
    """
    step = WINDOW - 2 * MARGIN
    n = max(1, -(-max(0, len(stream) - 2 * MARGIN) // step))
    padded = np.zeros((n - 1) * step + WINDOW, np.uint8)
    padded[:len(stream)] = stream
    view = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::step]
    chosen = np.arange(n) if covered is None else np.flatnonzero(_live(stream, covered, n, step))
    best: dict[Span, int] = {}
    cut_right: dict[int, Span] = {}  # of each window, the span that its end cuts
    cut_left: dict[int, Span] = {}

    def found(s: Span, depth: int) -> None:
        s = accept(s)
        if s:
            best[s] = max(best.get(s, -1), depth)

    for at in range(0, len(chosen), WINDOWS_AT_ONCE):
        part = chosen[at:at + WINDOWS_AT_ONCE]
        e = tagger.emissions(np.ascontiguousarray(view[part].T))
        live = np.flatnonzero(tagger.may_tag(e))
        if not len(live):
            continue
        tags = tagger.decode(np.ascontiguousarray(e[:, live]))
        for col, w in enumerate(part[live].tolist()):
            own = tags[:, col]
            if not own.any():
                continue
            base = w * step
            heads = own % 2 == 1
            heads[0] |= own[0] > 0
            for a in np.flatnonzero(heads).tolist():
                kind = int(own[a] - 1) // 2
                b = a + 1
                while b < WINDOW and own[b] == 2 + 2 * kind:
                    b += 1
                # How far the span is from the window's artificial edges.
                left = a if w else WINDOW
                right = WINDOW - b if w < n - 1 else WINDOW
                s = (base + a, kind, base + b)
                if right == 0:
                    cut_right[w] = s
                if left == 0:
                    cut_left[w] = s
                if left and right:
                    found(s, min(left, right))
    for w, s in cut_right.items():
        t = cut_left.get(w + 1)
        # One span, longer than the overlap, which both parts cover.
        if t and t[1] == s[1] and s[0] <= t[0] and t[2] >= s[2]:
            found((s[0], s[1], t[2]), 0)
    # Where spans of neighbouring windows contradict each other, the one further inside its window counts.
    out: list[Span] = []
    for s in sorted(best, key=lambda s: (-best[s], -(s[2] - s[0]), s)):
        if _clear(out, s):
            bisect.insort(out, s)
    return out


def find_spans(tagger: char_crf.Tagger, texts: list[str], skip: bool = True) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text; without ``skip`` every window is tagged, with the same result."""
    coded = [char_crf.classes_of(t) for t in texts]
    gap = np.zeros(1, np.uint8)
    stream = np.concatenate([p for c in coded for p in (c, gap)]) if coded else gap
    starts = np.concatenate([[0], np.cumsum([len(c) + 1 for c in coded])]).tolist()
    base = [base_spans(t) for t in texts]
    covered = np.zeros(len(stream), bool)
    for i, spans in enumerate(base):
        for a, _, b in spans:
            covered[starts[i] + a:starts[i] + b] = True

    def accept(s: Span) -> Span | None:
        """The span without white space around it, if it lies in one text, touches no base span and is plausible."""
        i = bisect.bisect_right(starts, s[0]) - 1
        if i >= len(texts) or s[2] > starts[i] + len(texts[i]):
            return None
        a, b = _trimmed(texts[i], s[0] - starts[i], s[2] - starts[i])
        if a >= b or covered[starts[i] + a:starts[i] + b].any() or not _plausible(s[1], texts[i][a:b]):
            return None
        return starts[i] + a, s[1], starts[i] + b

    added: list[list[Span]] = [[] for _ in texts]
    for a, k, b in stream_spans(tagger, stream, covered if skip else None, accept):
        i = bisect.bisect_right(starts, a) - 1
        added[i].append((a - starts[i], k, b - starts[i]))
    return [(own, sorted(own + more)) for own, more in zip(base, added)]


SPAN_TYPE = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("kind", T.StringType()),
                                      T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType())]))
#: Characters of text in one stream.
STREAM_CHARS = 4_000_000


def tag_documents(docs: DataFrame, tagger: char_crf.Tagger) -> DataFrame:
    """(doc_id, spans) of every row; spans: array of (start, kind, end, base), by start, then kind."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(tagger)  # a few thousand numbers
    narrow = docs.select("doc_id", "text")
    arrow = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, waiting, size = [], [], 0
            for k in range(batch.num_rows):
                waiting.append(batch.column(1)[k].as_py() or "")
                size += len(waiting[-1])
                if size >= STREAM_CHARS:
                    out += find_spans(shared.value, waiting)
                    waiting, size = [], 0
            if waiting:
                out += find_spans(shared.value, waiting)
            rows = []
            for base, every in out:
                plain = set(base)
                rows.append([{"start": a, "kind": KINDS[k], "end": b, "base": (a, k, b) in plain} for a, k, b in every])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, arrow)], ["doc_id", "spans"])

    return narrow.mapInArrow(run, T.StructType([T.StructField("doc_id", narrow.schema["doc_id"].dataType),
                                                T.StructField("spans", SPAN_TYPE)]))


def pii_digest(docs: DataFrame) -> DataFrame:
    tagged = tag_documents(docs, learn(docs))
    base = F.filter("spans", lambda s: s["base"])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                     s["end"].cast("string"))), ",")
    counts = [F.size(F.filter(base, _of_kind(k))).cast("bigint").alias(f"n_{k}") for k in KINDS]
    return tagged.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                         joined(F.col("spans")).alias("spans"))


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind
