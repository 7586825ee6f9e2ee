"""Fuzzy line deduplication by MinHash over character shingles, in DataFrame functions.

A document is cut at newlines.  The shingles of a line are all its runs of ``SHINGLE``
characters (code points), one beginning at every character; a line of fewer characters is one
shingle.  Two lines are near-duplicates at a Jaccard similarity of ``SIMILARITY`` or more.  Of
each connected component of near-duplicate lines the first occurrence, by (doc_id, line
number), is kept.  Blank lines are never touched.

*Signatures.*  Every line has a set of hashes to be found by.  For a line of at least ``WORDS`` different pairs of
neighbouring words, one to every ``CHARS_A_PAIR`` characters or more, it is the hashes of those pairs, some six
times fewer than the shingles: an edit that takes ten shingles takes two pairs.  Any other line (short, or with long
or no words) has the hashes of its shingles; if it has ``WORDS_NEAR`` pairs it has both, as a near line may have pairs
only.  One permutation MinHash by rotation: the sorted hashes lie on a ring; from each of ``BANDS`` (of pairs: ``PAIR_BANDS``) fixed points of the
ring the next ``ROWS`` hashes make a band.  Two lines agree in a band when the next hashes of
their union from there belong to both: at the threshold with probability ``SIMILARITY ** ROWS`` = 0.41, so all eight
miss with 0.015; at 0.9 with 0.0002.  The points of a short line often begin the same band, so lines of fewer than
``SHORT`` shingles are found by prefixes instead, which lose nothing: of the sorted hashes of two lines that
reach the threshold, the first ``n - ceil(SIMILARITY * n) + 1`` have one in common.  Lines that are
long enough for bands but can be near a short one have both.

*Candidates.*  Exact copies are one line from here on (a line a third of all documents share is one row per task
after partial aggregation): lines are known by a 64-bit hash and a 128-bit digest, in the graph by the hash
alone.  The lines of a bucket of two are a pair.  A larger bucket has two pivots: the line that occurs
most often (of near copies it is the original), and one drawn by hash.  Every line is first compared with the pivots of
its buckets only, however large the bucket.  In a bucket whose lines are then in one component nothing is left
to find.  In the others every line outside the bucket's commonest component is compared with
all lines of the bucket that are in another component and near enough in size to reach the
threshold.  Before pairs are verified, their sketches are compared: a bit for each of ``64 * SKETCH_LONGS`` parts that
a line's hashes are dealt over, set if the number of hashes there is odd.  Hashes that both lines have cancel out, so
every bit in which two sketches differ takes a shingle that one line has and the other lacks: a pair that differs in
more bits than lines at the threshold differ in shingles cannot reach it, and is not verified: nothing is lost.

*Verification* is exact, on the full sets of shingle hashes of both lines, made again from
their texts (sets of eight bytes a character are never written), then union-find over the links.

Defined cases: null and empty texts have no lines and stay as they are; ties are by line
number, then by text; rows that repeat (same doc_id and text) hold the same occurrence and
keep the same lines; a null doc_id sorts last; an empty table gives an empty result; further
columns pass through ``dedup_lines`` unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, unused
from .components import connected_components
from .line_sets import (_LOW, BANDS, HASH_BITS, LOG_SKETCH, PREFIXES, ROWS, SHINGLE, SHORT, SHORT_NEAR, SIMILARITY, SKETCH,  # noqa: F401
                        line_keys, near_lines, shingle_sets, sketches)  # (the plain version, for the tests)

#: Bands of word pairs: more, as lines at the threshold have fewer of them in common than shingles.
PAIR_BANDS = 12
#: A line is found by its word pairs alone if it has so many, and one to so many characters.
WORDS = 40
CHARS_A_PAIR = 12
#: A line of fewer is not found by word pairs at all.
WORDS_NEAR = 28
#: Words of 64 bits in a sketch.
SKETCH_LONGS = 16
#: Most candidate lines whose hashes are broadcast; beyond, they are joined by shuffle.
BROADCAST_DIGESTS = 300_000


def line_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, line_no, line, digest, id) of every line that is not blank; line_no from 0.

    ``text_key`` tells the texts of a repeated doc_id apart.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = docs.select("doc_id", F.xxhash64(text).alias("text_key"), F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    return lines.filter(F.col("line").rlike(r"[^\x20\x09-\x0D]")).withColumns(
        {"digest": F.unhex(F.md5(F.col("line").cast("binary"))), "id": F.xxhash64("line")})


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is made once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def run_hashes(line: Column) -> Column:
    """The distinct hashes of all runs of ``SHINGLE`` characters; in UTF-32 a character's place is known."""
    wide = 4 * SHINGLE

    def hashes(wide_line: Column) -> Column:
        begins = F.sequence(F.lit(1), F.greatest(F.octet_length(wide_line) - wide, F.lit(0)) + 1, F.lit(4))
        return F.transform(begins, lambda at: F.xxhash64(F.substring(wide_line, at, F.lit(wide))))

    return F.array_distinct(_let(F.encode(line, "UTF-32"), hashes))


def pair_hashes(line: Column) -> Column:
    """The distinct hashes of all pairs of neighbouring words; the last word is a pair with nothing."""
    return F.array_distinct(_let(F.split(line, " "), lambda words: F.transform(
        words, lambda word, at: F.xxhash64(word, F.get(words, at + 1)))))


def _bands(lines: DataFrame, sets: str, bands: int, seed: int) -> tuple[DataFrame, Column]:
    """``lines`` and the buckets of the sorted hashes ``sets`` (``ROWS`` or more), at most one for each band.

    The points of the ring are the beginnings of ``bands`` equal parts of the hashes' range;
    a band goes round the end of its line's hashes.  Points with the same next hashes are one bucket.
    """
    points = [(t << 64) // bands - (1 << 63) for t in range(bands)]
    # Sorted in with the hashes a point's place tells how many of them are below.
    lines = lines.withColumns({f"{sets}_at": F.sort_array(F.concat(F.col(sets), F.array(*map(F.lit, points)))),
                               f"{sets}_ring": F.concat(F.col(sets), F.slice(sets, 1, ROWS))})

    def key(t: int) -> Column:
        begin = F.array_position(f"{sets}_at", F.lit(points[t])).cast("int") - F.lit(t)
        return F.xxhash64(F.lit(seed), F.slice(f"{sets}_ring", begin, F.lit(ROWS)))

    return lines, F.array_distinct(F.array(*map(key, range(bands))))


def _prefixes(sets: str) -> Column:
    """The prefix buckets of the sorted hashes ``sets`` of short lines and their neighbours."""
    size = F.size(sets)
    wanted = F.when(size <= SHORT_NEAR, size - F.ceil(size * SIMILARITY - 1e-9).cast("int") + 1).otherwise(0)
    return F.transform(F.slice(sets, F.lit(1), wanted), lambda x: F.xxhash64(F.lit(-1), x))


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, line_no, digest, id, keys) of every line."""
    lines = line_rows(docs).withColumn("pairs", F.sort_array(pair_hashes(F.col("line"))))
    by_runs = (F.size("pairs") < WORDS) | (F.size("pairs") * CHARS_A_PAIR < F.length("line"))
    lines = lines.withColumn("runs", F.when(by_runs, F.sort_array(run_hashes(F.col("line")))))
    lines, pair_bands = _bands(lines, "pairs", PAIR_BANDS, 0)
    lines, run_bands = _bands(lines, "runs", BANDS, 1)
    none = F.array().cast("array<bigint>")
    keys = F.concat(F.when(F.size("pairs") >= WORDS_NEAR, pair_bands).otherwise(none),
                    F.when(F.size("runs") >= SHORT, run_bands).otherwise(none),
                    F.when(F.size("runs") <= SHORT_NEAR, _prefixes("runs")).otherwise(none))
    return lines.select("doc_id", "text_key", "line_no", "digest", "id", keys.alias("keys"))


def _sketch_columns() -> list[str]:
    return [f"bits{k}" for k in range(SKETCH_LONGS)]


def _candidate_lines(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, line, size, bits0, bits1, ...), once for each wanted id, from the texts read again.

    Copies of a line are combined in each task before anything is shuffled.  ``size`` is the number of shingles;
    a bit of the sketch tells if the number of their hashes in its part is odd.
    """
    lines = line_rows(docs).select("id", "line")
    if wanted.count() <= BROADCAST_DIGESTS:
        lines = lines.join(F.broadcast(wanted), "id", "left_semi").distinct()
    else:
        lines = lines.distinct().join(wanted, "id", "left_semi")
    lines = materialize(lines, "line-wanted-lines")
    runs = lines.select("id", F.explode(run_hashes(F.col("line"))).alias("run"))
    runs = runs.select("id", F.shiftright("run", 6).bitwiseAND(F.lit(SKETCH_LONGS - 1)).alias("part"), F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), F.col("run").bitwiseAND(F.lit(63)).cast("int")).alias("bit"))
    odd = [F.bit_xor(F.when(F.col("part") == k, F.col("bit")).otherwise(F.lit(0).cast("bigint"))).alias(c)
           for k, c in enumerate(_sketch_columns())]
    sketched = runs.groupBy(F.col("id").alias("of")).agg(F.count(F.lit(1)).alias("size"), *odd)
    return lines.join(sketched, F.col("id") == F.col("of")).drop("of")


def near(a: Column, b: Column) -> Column:
    """Is the similarity of two lines, given by their sets of hashes, at least the threshold."""
    both = F.size(F.array_intersect(a, b))
    return both >= (F.size(a) + F.size(b) - both) * F.lit(SIMILARITY)


def _side(texts: DataFrame, a: str, *more: str) -> DataFrame:
    """The sketches as columns of one side of a pair."""
    return texts.select(F.col("id").alias(a), *[F.col(c).alias(f"{c}_{a}") for c in ("size", *_sketch_columns(), *more)])


def _may_reach(a: str, b: str) -> Column:
    """Sizes and sketches of a pair allow for the threshold."""
    na, nb = F.col(f"size_{a}"), F.col(f"size_{b}")
    most = (na + nb) * F.lit((1 - SIMILARITY) / (1 + SIMILARITY)) + F.lit(1e-6)
    apart = sum((F.bit_count(F.col(f"{c}_{a}").bitwiseXOR(F.col(f"{c}_{b}"))) for c in _sketch_columns()), F.lit(0))
    return (F.least(na, nb) >= F.greatest(na, nb) * F.lit(SIMILARITY)) & (apart <= most)


def _sketched(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) that may reach the threshold."""
    both = pairs.join(_side(texts, "x"), F.col("a") == F.col("x"))
    return both.join(_side(texts, "y"), (F.col("b") == F.col("y")) & _may_reach("x", "y")).select("a", "b")


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose exact similarity reaches the threshold."""
    both = (pairs.join(texts.select(F.col("id").alias("x"), F.col("line").alias("line_x")), F.col("a") == F.col("x"))
            .join(texts.select(F.col("id").alias("y"), F.col("line").alias("line_y")), F.col("b") == F.col("y")))
    sets = both.select("a", "b", run_hashes(F.col("line_x")).alias("runs_x"), run_hashes(F.col("line_y")).alias("runs_y"))
    return sets.filter(near(F.col("runs_x"), F.col("runs_y"))).select("a", "b")


def _star_pairs(members: DataFrame, pivots: DataFrame) -> DataFrame:
    """Pairs (a, b) of the lines of a bucket and its pivots."""
    star = members.join(pivots, F.col("key") == F.col("pk")).select("id", F.explode(F.array_distinct("pivots")).alias("pivot"))
    return star.filter(F.col("id") != F.col("pivot")).select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b"))


def _open_pairs(members: DataFrame, found: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of one bucket in different components that may reach the threshold, at least one outside the
    bucket's commonest component."""
    placed = members.join(found, members["id"] == found["node"], "left").select("key", "id", F.coalesce("component", "id").alias("c"))
    counts = placed.groupBy("key", "c").agg(F.count(F.lit(1)).alias("n"))
    mixed = counts.groupBy("key").agg(F.max(F.struct("n", "c")).alias("top"), F.count(F.lit(1)).alias("kinds"))
    mixed = materialize(mixed.filter(F.col("kinds") > 1).select(F.col("key").alias("k"), F.col("top.c").alias("top")), "line-mixed")
    placed = placed.join(mixed, F.col("key") == F.col("k")).drop("k").join(
        texts.select(F.col("id").alias("d"), "size", *_sketch_columns()), F.col("id") == F.col("d")).drop("d")
    placed = materialize(placed, "line-placed")
    out = _side(placed.filter(F.col("c") != F.col("top")), "x", "key", "c")
    every = _side(placed, "y", "key", "c", "top")
    # Two outsiders meet once.
    on = ((F.col("key_x") == F.col("key_y")) & (F.col("c_x") != F.col("c_y")) & ((F.col("c_y") == F.col("top_y")) | (F.col("x") < F.col("y")))
          & _may_reach("x", "y"))
    return out.join(every, on).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _line_links(docs: DataFrame, each: DataFrame) -> DataFrame:
    """(node, component) of every id of ``each`` that is near another: the components of near lines."""
    keyed = each.select("id", "times", F.explode("keys").alias("key"))
    # Buckets of at least two different lines.
    buckets = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("a"), F.max("id").alias("b"))
    buckets = materialize(buckets.filter(F.col("a") < F.col("b")), "line-buckets")
    twos = buckets.filter(F.col("n") == 2).select("a", "b")
    large = buckets.filter(F.col("n") > 2).select("key")
    members = materialize(keyed.join(large, "key").select("key", "id", "times"), "line-members")
    turn = F.xxhash64("id", "key")
    pivots = members.groupBy(F.col("key").alias("pk")).agg(
        F.array(F.max(F.struct("times", turn.alias("turn"), "id"))["id"],
                F.min(F.struct(turn.alias("turn"), "id"))["id"]).alias("pivots"))
    pivots = materialize(pivots, "line-pivots")
    # The pairs are written, as the texts are: a pivot of very many lines is split by the adaptive skew join.
    pairs = materialize(twos.unionByName(_star_pairs(members, pivots)).distinct(), "line-pairs")
    wanted = twos.select(F.explode(F.array("a", "b")).alias("id")).unionByName(members.select("id")).distinct()
    texts = materialize(_candidate_lines(docs, materialize(wanted, "line-wanted")), "line-texts")
    links = materialize(_links(_sketched(pairs, texts), texts), "line-links")
    found = materialize(connected_components(links, "a", "b"), "line-near")
    rest = materialize(_links(_open_pairs(members, found, texts), texts), "line-rest")
    return found if rest.isEmpty() else materialize(connected_components(links.unionByName(rest), "a", "b"), "line-found")


def line_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, line_no, digest, component, kept) of every line that is not blank.

    ``component``: the least digest reachable over links, the line's own if it has none.
    """
    docs = docs.select("doc_id", "text")
    # One row for each different line: copies are combined before the shuffle, so a line
    # that a third of all documents hold is one row per task.
    each = signatures(docs).groupBy("id", "digest", "keys").agg(F.count(F.lit(1)).alias("times"))
    each = materialize(each, "line-distinct")
    found = _line_links(docs, each)
    # Lines that occur more than once or are near others; every other one is its own keeper.
    placed = each.select("id", "digest", "times").join(found, F.col("id") == F.col("node"), "left").filter(
        (F.col("times") > 1) | F.col("node").isNotNull()).select("id", "digest", F.col("component").alias("c"))
    placed = materialize(placed, "line-placed")
    least = placed.filter(F.col("c").isNotNull()).groupBy(F.col("c").alias("lc")).agg(F.min("digest").alias("least"))
    named = placed.join(least, F.col("c") == F.col("lc"), "left").select(
        F.col("id").alias("ni"), F.col("digest").alias("nd"), F.coalesce("least", "digest").alias("component"))
    named = materialize(named, "line-named")
    occurrence = ["doc_id", "text_key", "line_no", "digest"]
    lines = line_rows(docs).select(*occurrence, "id")
    few = F.broadcast(named) if named.count() <= BROADCAST_DIGESTS else named
    lines = lines.join(few, (F.col("id") == F.col("ni")) & (F.col("digest") == F.col("nd")), "left").select(*occurrence, "component")
    lines = materialize(lines, "line-components")
    alone = lines.filter(F.col("component").isNull()).select(*occurrence, F.col("digest").alias("component"), F.lit(True).alias("kept"))
    # Keepers: the least occurrence per component, joined back (never a window over a component);
    # written first, so that both sides of the join are plain exchanges, which the adaptive skew join splits.
    lines = lines.filter(F.col("component").isNotNull())
    order = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "line_no", "text_key")
    keepers = materialize(lines.groupBy("component").agg(F.min(order).alias("k")).select(F.col("component").alias("kc"), "k"),
                          "line-keepers")
    kept = (F.col("k.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("k.line_no") == F.col("line_no"))
            & (F.col("k.text_key") == F.col("text_key")))
    shared = lines.join(keepers, F.col("component") == F.col("kc")).select(*occurrence, "component", kept.alias("kept"))
    return alone.unionByName(shared)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines that were not kept taken out of ``text``; every row stays, n_chars (if there) follows.

    Of a document's lines the removed ones go; blank lines and the order stay.
    """
    own, key, numbers, lines = unused(docs, "gone_id", "gone_key", "gone", "lines")
    gone = (line_classes(docs).filter(~F.col("kept")).groupBy(F.col("doc_id").alias(own), F.col("text_key").alias(key))
            .agg(F.collect_set("line_no").alias(numbers)))
    here = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    joined = docs.join(gone, F.col("doc_id").eqNullSafe(F.col(own)) & (here == F.col(key)), "left")
    joined = joined.withColumn(lines, F.split(F.col("text"), "\n"))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(numbers))
    left = F.array_join(F.transform(stay, lambda i: F.get(F.col(lines), i)), "\n")
    joined = joined.withColumn("text", F.when(F.col(numbers).isNull(), F.col("text")).otherwise(left))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.when(F.col(numbers).isNull(), F.col("n_chars")).otherwise(
            F.length("text").cast(docs.schema["n_chars"].dataType)))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns])


def lines_digest(docs: DataFrame) -> DataFrame:
    return line_classes(docs).select("doc_id", "line_no", F.lower(F.hex("component")).alias("line_class"), "kept")
