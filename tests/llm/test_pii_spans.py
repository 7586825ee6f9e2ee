"""The tagger on hand-written forms, the exact bound that skips windows, and spans at window seams."""

import random
import re
import time

import numpy as np
import pytest

from llm_helpers import con  # noqa: F401
from starling.llm import char_crf, pii

#: Written by hand: forms and sentences that the training windows do not make.  The span is between the bars.
WRITTEN = [
    ("email", "Please write to |jane.miller at weatherdesk dot org| before the end of March."),
    ("email", "Contact: |k.olsen[at]harbour-office[dot]net| (office hours only)"),
    ("email", "my address is |samuel (at) brickyard (dot) com|, thanks!"),
    ("email", "* Support - |help@ northfield.org|"),
    ("email", "Send the forms to |r.dupont at mairie dot fr|; she reads them daily."),
    ("ip", "The server answered from |192 . 168 . 14 . 7| and then went silent."),
    ("ip", "block |10[.]44[.]3[.]201| at the firewall"),
    ("ip", "Host at |172 dot 16 dot 254 dot 1| did not respond in time."),
    ("card", "Paid with |4111.1111.1111.1111| on the second try."),
    ("card", "card no |5500/0000/0000/0004|, valid thru next year"),
    ("card", "He read it out: |4012_8888_8888_1881| and hung up."),
    ("phone", "Call us: |(415) 555-2671| or come by."),
    ("phone", "Tel. |020 7946 0958|"),
    ("phone", "Her number, |212-555-0187|, was written on the back."),
    ("phone", "ring |0044 161 496 0000| after six"),
    ("phone", "fax |503.555.0142| / ask for Ben"),
]
#: Digits, dots and "at" that are no personal data.
CLEAN = [
    "In 1998 the town had 12,450 people and 3 schools.",
    "See section 4.2.1 of the manual, or chapter 12.",
    "We met at noon and looked at the dotted line on the map.",
    "The anecdote was told at dinner; nobody dozed off.",
    "Version 2.10.3 fixes issues 881, 902 and 1177.",
    "They sold 3 for 2.50 and 10 for 8.00 on 14/03/2021.",
    "Population density: 1,204.5 per square mile.",
    "At dot-com companies the data team sat at the back.",
    "ISBN 978-0-306-40615-7 is out of print.",
    "The score was 21-17, 19-21, 15-12 after 64 minutes.",
]


@pytest.fixture(scope="module")
def tagger(spark):
    return pii.learn(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_hand_written_forms(tagger):
    """Recall over forms and contexts from elsewhere, and precision over them and clean sentences."""
    texts = [t.replace("|", "") for _, t in WRITTEN] + CLEAN
    found = [every for _, every in pii.find_spans(tagger, texts)]
    hits = right = 0
    for (kind, t), spans in zip(WRITTEN, found):
        a, b = t.index("|"), t.rindex("|") - 1
        good = [s for s in spans if s[1] == pii.KINDS.index(kind) and s[0] < b and s[2] > a]
        hits += bool(good)
        right += len(good)
    total = sum(len(s) for s in found)
    print(f"recall {hits}/{len(WRITTEN)}, precision {right}/{total}, spans in clean sentences {sum(map(len, found[len(WRITTEN):]))}")
    assert hits >= 0.6 * len(WRITTEN)
    assert right >= 0.75 * total


def test_skipped_windows_change_nothing(tagger, con):
    """The bound is exact: tagging every window gives the same spans."""
    texts = [t or "" for (t,) in con.execute("SELECT text FROM documents ORDER BY doc_id LIMIT 400").fetchall()]
    rng = random.Random(8)
    put = [t.replace("|", "") for _, t in WRITTEN]
    filler = "plain words go on and on without an end to them, "
    texts += ["".join(filler * rng.randint(0, 60) + rng.choice(put) + " " for _ in range(4)) for _ in range(40)]
    few, every = pii.find_spans(tagger, texts), pii.find_spans(tagger, texts, skip=False)
    assert few == every
    assert sum(len(s) > len(b) for b, s in few) > 20


def test_most_plain_windows_are_skipped():
    text = "plain words go on and on, in 1998 and after that too. " * 2000
    stream = char_crf.classes_of(text)
    step = pii.WINDOW - 2 * pii.MARGIN
    n = -(-(len(stream) - 2 * pii.MARGIN) // step)
    covered = np.zeros(len(stream), bool)
    assert not pii._live(char_crf.classes_of(text.replace("1998", "then")), covered, n, step).any()
    assert pii._live(stream, covered, n, step).all()  # digits enough in every window
    assert not pii._live(stream, ~covered, n, step).any()  # but not if base spans cover them


class Marked:
    """A tagger that tags what lies between two brackets as an address, whichever window it sees it in."""

    def emissions(self, x):
        return x

    def may_tag(self, e):
        return np.ones(e.shape[1], bool)

    def decode(self, e):
        opening, closing = char_crf.classes_of("<>")
        depth = np.cumsum(e == opening, axis=0) - np.cumsum(e == closing, axis=0)
        depth += np.maximum(0, -depth.min(axis=0))  # begun before the window
        return np.where((depth > 0) & (e != opening), np.where(np.roll(e, 1, axis=0) == opening, 1, 2), 0).astype(np.int8)


def test_span_cut_by_both_windows_is_joined():
    """An address longer than the overlap, over every seam: found once and whole."""
    step = pii.WINDOW - 2 * pii.MARGIN
    address = "a" * 70 + "@" + "b" * 70 + ".org"
    for lead in range(step - 150, step + 60, 7):
        text = "x" * lead + "<" + address + ">" + "y" * 2500
        spans = pii.stream_spans(Marked(), char_crf.classes_of(text))
        assert spans == [(lead + 1, 0, lead + 1 + len(address))], lead


def test_dense_and_long_streams_take_linear_time():
    text = "call <someone> now " * 40_000
    start = time.time()
    spans = pii.stream_spans(Marked(), char_crf.classes_of(text))
    assert len(spans) == 40_000 and time.time() - start < 20
    assert all(a[2] <= b[0] for a, b in zip(spans, spans[1:]))


def test_address_check_follows_the_pattern_without_backtracking():
    """Same answers as the plain pattern, and no blow-up on many "dot"s."""
    plain = re.compile(r"[a-z0-9._%+-]+\s?[\[(]?\s?(@|at)\s?[\])]?\s?[a-z0-9-]+(\s?[\[(]?\s?(\.|dot)\s?[\])]?\s?[a-z0-9-]+)+")
    rng = random.Random(3)
    kinds = ["a", "at", "dot", ".", " ", "(", ")", "@", "-", "x", "[at]", " at ", " dot "]
    for _ in range(20_000):
        t = "".join(rng.choice(kinds) for _ in range(rng.randint(2, 9)))
        want = bool(plain.fullmatch(t)) and any(m in t for m in ("@", "dot", "(at)", "[at]"))
        assert pii._plausible(0, t) == want, t
    start = time.time()
    assert not pii._plausible(0, "a at " + "dotdot dot " * 90 + "!")
    assert time.time() - start < 1


def test_training_rows_are_bounded_when_an_id_repeats(spark):
    """Ids that repeat, or are null, neither send all their rows to training nor none."""
    docs = spark.range(3000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "concat('reach me at +1 415 555 ', id + 1000, ' or not') AS text")
    model = pii.learn(docs, texts=200)
    assert pii.find_spans(model, ["reach me at +1 415 555 2671 or not"])[0][0]
    chosen = pii.learn(docs.limit(0))
    assert isinstance(chosen, char_crf.Tagger)
