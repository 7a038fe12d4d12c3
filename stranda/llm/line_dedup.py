"""Line deduplication: equal lines, and lines within a small edit distance by a segment-partition join.

Lines are known by hashes; texts are shuffled only for lines that may be in a pair, and pairs are decided on texts.
A line is cut into ``DISTANCE + 1`` segments of nearly equal length; two lines within the distance share one
of them unchanged. Segments are indexed under their number and their text, whose length is that of few line
lengths. Lines probe the index with the few substrings that multi-match-aware selection leaves for their own and up
to ``DISTANCE`` shorter lengths; substrings that several lengths have in common are probed once. The index holds
the smallest and the largest line of each segment: where they are one, a probe that meets it is a candidate pair;
where several lines share a segment, they are joined in blocks with those that probe it under a bound on their
letter counts. Candidates are verified with banded bit-parallel edit distance. Only DataFrame functions are used.

Where the caller asks for it, long lines are also compared by words: two lines are near copies if one in
``WORDS_EACH`` words of the shorter one, or fewer, are changed, added or dropped. Words have one order for all lines,
long ones first. Two lines that differ in d words have ``LEVELS`` words in common among the first d + LEVELS of each
line's words in that order, so these are its keys. Lines that share a key of ``FEW_LINES`` lines or fewer are joined;
a key of more lines is told apart by a second such word, but not in lines of ``LONG`` words or more, which have many. The lines
of a key that still has more are compared with a few of them, and with ``STARS`` more where links leave them in several
components; what is still apart then is joined in blocks, each pair under the first key that its lines share only, if its outlines (a code
point for each word) are near. All joins carry a bound on words that only one of two lines
has, from the parities of their words in 128 bits, 256 in long lines. Two edits of code points change four words at most, so lines of ``MANY_WORDS``
words or more need no segments. Pairs are decided on texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dealt, large_keys, materialize, repeated, settled
from .components import connected_components

#: Largest edit distance, in code points, between two lines that count as the same.
DISTANCE = 2
#: Shorter lines are compared with none by edit distance, and left alone where the caller asks for no more.
LEAST_CHARS = 20
#: Shortest equal lines that the queries take out: all that are not empty.
EQUAL_CHARS = 1
#: Letters that are counted where many lines share a segment; an edit changes the sum of differences by two at most.
COUNTED = "etaoinshrdlu"
#: One word in so many may differ between long lines that count as the same.
WORDS_EACH = 10
#: Lines of a key that are joined as they are, and the most words of the keys that tell more lines apart.
FEW_LINES, LEVELS = 64, 2
#: Lines from so many words on have keys of one word only; those of up to a fourth more have the others too.
LONG = 200
#: Residues of line hashes that the broadcast filter of verified lines may hold.
RESIDUES = 1 << 20
#: A line with more than this share of all lines is probed once; there are at most so many such lines, and keys.
FREQUENT = 1 << 16
#: From so many words on, lines within DISTANCE code points are found by their words: two edits change four words at most.
MANY_WORDS = 20
#: Rounds in which the lines of a key are compared with one more of them before all pairs that are left.
STARS = 2
#: Rows of keys that are still torn for which another such round is worth its jobs; fewer are joined at once.
TORN_ROWS = 1 << 17
#: Most keys of many lines that are broadcast (about 64 bytes each); beyond that all keys are shuffled.
SHARED = 1 << 16


def _pos() -> Column:
    """Place of a line in the corpus as one number: documents by doc_id, then lines."""
    return F.col("doc_id").cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(10,0)") + F.col("line_no").cast("decimal(10,0)")


def occurrences(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """doc_id, line_no, line, two hashes of the line and its place, for all visible lines of ``least`` code points or more."""
    lines = docs.filter("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")
    )
    lines = lines.filter((F.char_length("line") >= least) & F.col("line").rlike(r"\S"))
    return lines.select(
        "doc_id", "line_no", "line", F.xxhash64("line").alias("id"), F.xxhash64(F.lit(1), "line").alias("id2"), _pos().alias("pos")
    )


def _places(distance: int, residue: int) -> list[tuple[int, int, int, bool]]:
    """What a line of ``q * (distance + 1) + residue`` code points is probed with.

    (segment k, b, c, own): the ``q + c`` code points from ``q * k + b`` on; its own segments are those it is indexed by.
    """
    parts, found = distance + 1, {}
    for shorter in range(parts):
        less, rest = divmod(residue - shorter, parts)
        for k in range(parts):
            size = less + (rest >= parts - k)
            for shift in range(max(-k, shorter - (distance - k)), min(k, shorter + (distance - k)) + 1):
                place = (k, k * less + max(0, rest + k - parts) + shift, size)
                found[place] = found.get(place, False) or (shorter, shift) == (0, 0)
    return sorted((*place, own) for place, own in found.items())


def _keys(lines: DataFrame, distance: int, own: bool) -> DataFrame:
    """(key, id) for the segments of each of ``lines`` (line, id), or for all other substrings it is probed with.

    A row for each place comes first and its key after, so the generated code stays small.
    """
    parts = distance + 1

    def rows(residue: int) -> Column:
        some = [p for p in _places(distance, residue) if p[3] == own]
        return F.array(*(F.struct(F.lit(k).alias("k"), F.lit(b).alias("b"), F.lit(c).alias("c")) for k, b, c, _ in some))

    places = rows(0)
    for residue in range(1, parts):
        places = F.when(F.col("n") % parts == residue, rows(residue)).otherwise(places)
    counted = lines.select("line", "id", F.char_length("line").alias("n"))
    spread = counted.select("line", "id", F.call_function("div", "n", F.lit(parts)).cast("int").alias("q"), F.explode(places).alias("x"))
    part = F.substr("line", F.col("q") * F.col("x.k") + F.col("x.b") + 1, F.col("q") + F.col("x.c"))
    return spread.select(F.xxhash64("x.k", part).alias("key"), "id")


def _letters(line: Column) -> list[Column]:
    """The letter counts modulo 256, six in a number."""
    out = []
    for six in (COUNTED[:6], COUNTED[6:]):
        packed = F.lit(0).cast("long")
        for letter in six:
            packed = packed * 256 + (F.octet_length(line) - F.octet_length(F.replace(line, F.lit(letter), F.lit("")))) % 256
        out.append(packed)
    return out


def _near_letters(a: str, b: str, distance: int | Column) -> Column:
    total = F.lit(0)
    for half in ("0", "1"):
        for k in range(6):
            byte = lambda x, k=k: F.shiftright(x, 8 * k).bitwiseAND(F.lit(255).cast("long"))
            gap = F.abs(byte(F.col(a + half)) - byte(F.col(b + half)))
            total = total + F.least(gap, 256 - gap)
    return total <= distance * 2


def _bind(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


#: Code points compared at once where two lines begin alike.
CHUNK = 16


def _unlike(long: Column, short: Column) -> tuple[Column, Column]:
    """Both texts without the chunks that they begin with in common."""
    piece = lambda x, i: F.substr(x, (i * CHUNK + 1).cast("int"), F.lit(CHUNK))
    chunks = F.sequence(F.lit(0), F.call_function("div", F.char_length(short), F.lit(CHUNK)).cast("int"))
    first = F.coalesce(F.get(F.filter(chunks, lambda i: piece(long, i) != piece(short, i)), F.lit(0)), F.lit(0))
    return F.substr(long, first * CHUNK + 1), F.substr(short, first * CHUNK + 1)


def edit_distance(long: Column, short: Column, distance: int) -> Column:
    """Edit distance of two texts if it is at most ``distance`` (30 at most), else some larger number.

    ``short`` must not be longer than ``long``, nor shorter by more than ``distance``. Bits of a word are the
    cells of a band around the diagonal: differences between neighbouring rows of a column, which one round
    of additions and logical operations carries to the next column. Values on the diagonal never fall, so a
    pair that has passed ``distance`` is carried on without further work.
    """
    k = distance
    mask = (1 << (2 * k + 1)) - 1
    zero = F.lit(0).cast("long")
    flip = lambda c: F.bitwise_not(c).bitwiseAND(F.lit(mask))

    def next_column(v: Column, state: Column, at: Column) -> Column:
        equal = zero
        for b in range(2 * k + 1):
            same = F.coalesce(F.get(v["x"], at["j"] + F.lit(b - k)) == at["c"], F.lit(False))
            equal = equal.bitwiseOR(F.when(same, F.lit(1 << b).cast("long")).otherwise(zero))
        up = F.shiftright(state["up"], 1).bitwiseOR(F.lit(1 << (2 * k)).cast("long"))
        down = F.shiftright(state["down"], 1)
        parts = F.struct(up.alias("up"), down.alias("down"), equal.alias("equal"))
        return _bind(parts, lambda p: with_parts(v, state, p))

    def with_parts(v: Column, state: Column, p: Column) -> Column:
        level = (p["equal"].bitwiseAND(p["up"]) + p["up"]).bitwiseXOR(p["up"]).bitwiseOR(p["equal"]).bitwiseOR(p["down"])
        return _bind(level.bitwiseAND(F.lit(mask)), lambda d: with_level(v, state, p, d))

    def with_level(v: Column, state: Column, p: Column, d: Column) -> Column:
        right = F.shiftleft(p["down"].bitwiseOR(flip(d.bitwiseOR(p["up"]))), 1).bitwiseOR(F.lit(1))
        return _bind(right.bitwiseAND(F.lit(mask)), lambda h: with_right(v, state, p, d, h))

    def with_right(v: Column, state: Column, p: Column, d: Column, h: Column) -> Column:
        left = F.shiftleft(p["up"].bitwiseAND(d), 1).bitwiseAND(F.lit(mask))
        moved = F.when(d.bitwiseAND(v["diagonal"]) != 0, zero).otherwise(F.lit(1).cast("long"))
        return F.struct(
            left.bitwiseOR(flip(d.bitwiseOR(h))).alias("up"), d.bitwiseAND(h).alias("down"), (state["score"] + moved).alias("score")
        )

    def run(v: Column) -> Column:
        start = F.struct(
            F.lit(mask & ~((1 << (k + 1)) - 1)).cast("long").alias("up"), zero.alias("down"), (F.size(v["x"]) - F.size(v["y"])).cast("long").alias("score")
        )
        columns = F.transform(v["y"], lambda c, j: F.struct(c.alias("c"), j.alias("j")))
        step = lambda s, at: F.when(s["score"] > k, s).otherwise(next_column(v, s, at))
        return F.aggregate(columns, start, step, lambda s: s["score"])

    letters = lambda x: F.filter(F.split(x, ""), lambda c: c != "")
    diagonal = F.call_function("shiftleft", F.lit(1).cast("long"), (k + F.char_length(long) - F.char_length(short)).cast("int"))
    rest = _unlike(long, short)
    return _bind(F.struct(letters(rest[0]).alias("x"), letters(rest[1]).alias("y"), diagonal.alias("diagonal")), run)


def line_classes(lines: DataFrame) -> DataFrame:
    """The hashes of each distinct line, its first place and how often it occurs."""
    return lines.groupBy("id", "id2").agg(F.min("pos").alias("first"), F.count("*").alias("held"))


def _once(lines: DataFrame, classes: DataFrame) -> DataFrame:
    """(line, id, pos) of ``lines`` that may be near copies, frequent ones at their first place only."""
    total = classes.agg(F.sum("held")).head()[0] or 0
    # at most FREQUENT rows
    frequent = classes.filter(F.col("held") > max(8, total // FREQUENT)).select("id", "id2", "first")
    some = lines.filter(F.char_length("line") >= LEAST_CHARS)
    return some.join(F.broadcast(frequent), ["id", "id2"], "left").filter("first is null or first = pos").select("line", "id", "pos")


def _sieved(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rows`` (id and more) without most of those whose id is not in ``wanted`` (id); it only spares a join rows it would drop."""
    # at most RESIDUES rows
    residues = wanted.select(F.pmod("id", F.lit(RESIDUES)).alias("residue")).distinct()
    return rows.join(F.broadcast(residues), F.pmod("id", F.lit(RESIDUES)) == F.col("residue"), "left_semi")


def _some_lines(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, line) of the lines whose hashes are in ``wanted`` (id), once each."""
    some = _sieved(lines.select("id", "line"), wanted)
    return some.groupBy("id", "line").agg(F.count("*")).select("id", "line").join(wanted, "id", "left_semi")


def _near_by_chars(long: Column, short: Column, distance: int) -> Column:
    return (F.char_length(long) - F.char_length(short) <= distance) & (edit_distance(long, short, distance) <= distance)


def _ordered(both: DataFrame) -> DataFrame:
    """a, b and their lines, the longer as ``t`` and the other as ``s``."""
    shorter = F.char_length("a_line") <= F.char_length("b_line")
    s = F.when(shorter, F.col("a_line")).otherwise(F.col("b_line")).alias("s")
    return both.select("a", "b", s, F.when(shorter, F.col("b_line")).otherwise(F.col("a_line")).alias("t"))


def similar_lines(lines: DataFrame, classes: DataFrame, distance: int = DISTANCE, fewer_words: int | None = None) -> DataFrame:
    """Pairs (a, b) of hashes of different lines within ``distance``; every such pair of ``lines`` is linked.

    Lines under LEAST_CHARS code points are in no pair, nor lines of ``fewer_words`` words or more.
    """
    once = _once(lines, classes)
    if fewer_words is not None:
        once = once.filter(_n_words(F.col("line")) < fewer_words)
    index = _keys(once, distance, True).groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("last"))
    index = materialize(index, "segments")
    found = _keys(once, distance, False).withColumnRenamed("id", "b").join(index.hint("shuffle_hash"), "key").filter("a <> last or a <> b")
    shared = F.col("a") != F.col("last")
    none = F.lit(None).cast("long")
    hits = found.select(F.when(shared, F.col("key")).alias("key"), F.when(~shared, F.col("a")).alias("a"), "b", F.lit(False).alias("own")).distinct()
    crowd = materialize(index.filter(shared).select("key"), "shared-segments")
    own = _keys(once, distance, True).join(crowd, "key", "left_semi").distinct().select("key", none.alias("a"), F.col("id").alias("b"), F.lit(True).alias("own"))
    met = materialize(hits.union(own), "line-hits")
    wanted = met.select(F.col("b").alias("id")).union(met.filter("a is not null").select("a")).distinct()
    low, high = _letters(F.col("line"))
    texts = materialize(_some_lines(lines, wanted).withColumns({"l0": low, "l1": high}), "line-texts")
    counts = texts.select("id", F.char_length("line").alias("n"), "l0", "l1").distinct()
    held = materialize(met.filter("key is not null").select("key", "b", "own").join(counts, F.col("b") == F.col("id")).drop("b"), "line-sharers")
    members = held.filter("own").select("key", F.col("id").alias("a"), F.col("n").alias("a_n"), F.col("l0").alias("a0"), F.col("l1").alias("a1"))
    seekers = held.select("key", F.col("id").alias("b"), F.col("n").alias("b_n"), F.col("l0").alias("b0"), F.col("l1").alias("b1")).distinct()
    large = large_keys(members, "key")
    near = (F.col("a_n") < F.col("b_n")) | (F.col("a_n") == F.col("b_n")) & (F.col("a") < F.col("b"))
    near = near & (F.col("b_n") - F.col("a_n") <= distance) & _near_letters("a", "b", distance)
    crowded = dealt(members, large, "key", "a").join(repeated(seekers, large, "key"), ["key", "block"]).filter(near).select("a", "b")
    pairs = met.filter("a is not null").select("a", "b").union(crowded).distinct()
    a, b = (texts.select(F.col("id").alias(s), F.col("line").alias(f"{s}_line")) for s in "ab")
    both = _ordered(pairs.join(a, "a").join(b, "b"))
    return both.filter(_near_by_chars(F.col("t"), F.col("s"), distance)).select("a", "b").distinct()


def _tokens(line: Column) -> Column:
    return F.filter(F.split(line, r"\s+"), lambda w: w != "")


def _is_odd(line: Column) -> Column:
    """Whether anything but single spaces stands between words."""
    odd = F.startswith(line, F.lit(" ")) | F.endswith(line, F.lit(" "))
    for other in ("  ", "\t", "\r", "\x0b", "\x0c"):
        odd = odd | F.contains(line, F.lit(other))
    return odd


def _n_words(line: Column) -> Column:
    """Words of a line, counted without making them where single spaces separate them."""
    return F.when(_is_odd(line), F.size(_tokens(line))).otherwise(F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1)


def _words(line: Column) -> Column:
    return F.when(_is_odd(line), _tokens(line)).otherwise(F.split(line, " "))


def _rank(word: Column) -> Column:
    """The place of a word in the order of all words: long ones first, then by hash."""
    short = (F.lit(63) - F.least(F.octet_length(word), F.lit(63))).cast("long")
    return F.shiftleft(short, 56).bitwiseOR(F.shiftrightunsigned(F.xxhash64(word), 8))


def _parity(ranks: Column, mask: int, which: int) -> Column:
    """Whether the number of words of each of 64 classes is odd, of those words of which two bits under ``mask`` are ``which``.

    A word more or less changes one bit.
    """
    at = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(F.lit(63).cast("long")).cast("int"))
    own = lambda x: F.shiftright(x, 6).bitwiseAND(F.lit(mask).cast("long")) == which
    return F.aggregate(ranks, F.lit(0).cast("long"), lambda s, x: F.when(own(x), s.bitwiseXOR(at(x))).otherwise(s))


def _word_sets(lines: DataFrame, distance: int) -> DataFrame:
    """(id, KNOWN, keys) of ``lines`` (line, id) of WORDS_EACH words or more, with the first of their words as keys."""
    own = lines.select("id", "line", _n_words(F.col("line")).alias("n")).filter(F.col("n") >= WORDS_EACH)
    own = own.select("id", "n", F.transform(_words(F.col("line")), _rank).alias("r"))
    none, long = F.lit(0).cast("long"), F.col("n") >= LONG
    halves = [_parity(F.col("r"), 1, k) for k in (0, 1)]
    fourths = [F.when(long, _parity(F.col("r"), 3, k)).otherwise(none) for k in (2, 3)]
    keys = F.slice(F.sort_array("r"), F.lit(1), _most_words(F.col("n"), distance) + LEVELS)
    return own.select("id", "n", *(p.alias(f"p{k}") for k, p in enumerate(halves + fourths)), keys.alias("keys"))


#: Code points that words are told apart by in an outline, from U+10000 up.
CODES = 1 << 20


def _code(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(CODES))


def _outline(words: Column) -> Column:
    """A code point for each word; very few different words have the same."""
    return F.decode(F.unhex(F.array_join(F.transform(words, lambda w: F.lpad(F.hex(_code(w) + 0x10000), 8, "0")), "")), "UTF-32")


def _told_apart(words: Column) -> Column:
    """Whether different ``words`` have different code points."""
    return F.size(F.array_distinct(words)) == F.size(F.array_distinct(F.transform(words, _code)))


def _most_words(n: Column, distance: int) -> Column:
    """How many words of a line of ``n`` words and a near copy that has no fewer may differ, by the rule of words or of code points."""
    words = F.call_function("div", n, F.lit(WORDS_EACH)).cast("int")
    return F.when(n >= MANY_WORDS, F.greatest(words, F.lit(2 * distance))).otherwise(words)


def _word_distance(a: Column, b: Column, distance: Column) -> Column:
    """Whether two arrays of words are within ``distance``: each word of the pair is one code point of its own."""

    def told(v: Column) -> Column:
        text = lambda words: F.array_join(
            # code points from U+10000 up, clear of surrogates
            F.transform(words, lambda w: F.decode(F.unhex(F.lpad(F.hex(F.array_position(v["all"], w) + 0xFFFF), 8, "0")), "UTF-32")), ""
        )
        return F.call_function("levenshtein", text(v["a"]), text(v["b"]), v["d"])

    return _bind(F.struct(F.array_distinct(F.concat(a, b)).alias("all"), a.alias("a"), b.alias("b"), distance.alias("d")), told) >= 0


def similar_by_words(lines: DataFrame, classes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs (a, b) of hashes of different lines of which one word in WORDS_EACH of the shorter, or fewer, differ.

    Lines of MANY_WORDS words or more within ``distance`` (2 at most) code points are linked too.
    """
    sets = materialize(_word_sets(_once(lines, classes), distance), "word-sets")
    # lines that are near each other are both short or both long, or in between
    found, held = _few_and_many(sets.filter(F.col("n") < LONG * 5 // 4), distance, LEVELS)
    more, long = _few_and_many(sets.filter(F.col("n") >= LONG), distance, 1)
    found, held = found.union(more), held.union(long)
    first = [F.min("id"), F.max("id"), *(F.min_by("id", F.xxhash64("id", F.lit(STARS + k))) for k in range(2))]
    pairs = materialize(found.union(_star_pairs(held, first, distance)).distinct(), "word-pairs")
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).union(held.select("id")).distinct()
    texts = _some_lines(lines, materialize(wanted, "wanted-lines")).withColumn("w", _words(F.col("line")))
    texts = materialize(texts.select("id", "line", F.size("w").alias("n"), _outline(F.col("w")).alias("c")), "word-texts")
    links = materialize(_confirmed(pairs, texts, distance), "line-links")
    if held.isEmpty():
        return links
    torn = settled("torn-keys", lambda: _torn_keys(held, links))
    for star in range(STARS):
        if torn.count() < TORN_ROWS:
            break
        leader = F.min_by("id", F.xxhash64("id", F.lit(star)))
        some = settled("word-pairs", lambda torn=torn, leader=leader, done=pairs: _star_pairs(torn, [leader], distance).join(done, ["a", "b"], "left_anti"))
        if some.isEmpty():
            break
        more = settled("line-links", lambda some=some: _confirmed(some, texts, distance))
        pairs, links = pairs.union(some), links.union(more)
        torn = settled("torn-keys", lambda torn=torn, links=links: _torn_keys(torn.drop("component"), links))
    rest = settled("word-pairs", lambda: _cross_pairs(torn, distance, texts).join(pairs, ["a", "b"], "left_anti"))
    return links.union(_confirmed(rest, texts, distance))


#: What is known of a line where only its keys are: its number of words, and the parities of halves and fourths of them.
KNOWN = ("n", "p0", "p1", "p2", "p3")


def _frequent(rows: DataFrame) -> DataFrame:
    """The keys of ``rows`` (key and more) that have more than FEW_LINES rows."""
    keys = materialize(rows.groupBy("key").agg(F.count("*").alias("held")).filter(F.col("held") > FEW_LINES).select("key"), "frequent-keys")
    return F.broadcast(keys) if keys.count() <= SHARED else keys


def _longer_keys(rows: DataFrame) -> DataFrame:
    """``rows`` (id, KNOWN, key, last, before, rest) with the words of ``rest`` added to their keys, one to each.

    ``last`` is the last word of a key and ``before`` has the other words up to it that the key leaves out. A key of one word twice leaves out none.
    """
    spread = rows.select("id", *KNOWN, "key", "last", "before", "rest", F.posexplode("rest").alias("at", "word"))
    rest = F.slice("rest", F.col("at") + 2, F.size("rest"))
    # bounded by one line
    passed = F.array_distinct(F.concat("before", F.slice("rest", F.lit(1), F.col("at"))))
    passed = F.array_except(passed, F.array("last", "word"))
    before = F.when(F.col("last").eqNullSafe(F.col("word")), F.array().cast("array<long>")).otherwise(passed)
    return spread.select("id", *KNOWN, F.xxhash64("key", "word").alias("key"), F.col("word").alias("last"), before.alias("before"), rest.alias("rest"))


def _few_and_many(sets: DataFrame, distance: int, levels: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) that may be near of lines that share a key of few lines, and (key, id, KNOWN, before) of keys of ``levels`` words that have many.

    ``before`` has the words that come before a line's last word of the key and are not in it.
    """
    rows = sets.select("id", *KNOWN, F.explode(F.array_distinct("keys")).alias("key"))
    frequent = _frequent(rows)
    found = _near_pairs(rows.join(frequent, "key", "left_anti"), distance)
    if levels == LEVELS:
        words = sets.select("id", *KNOWN, F.posexplode("keys").alias("at", "key")).join(frequent, "key", "left_semi")
        # bounded by one line
        words = words.groupBy("id", *KNOWN).agg(F.array_sort(F.collect_set(F.struct("at", "key"))).alias("rest"))
        words = words.select("id", *KNOWN, F.lit(0).cast("long").alias("key"), F.lit(None).cast("long").alias("last"), F.array().cast("array<long>").alias("before"), F.col("rest")["key"].alias("rest"))
        rows = _longer_keys(_longer_keys(materialize(words, "frequent-words")))
        frequent = _frequent(rows)
        found = found.union(_near_pairs(rows.join(frequent, "key", "left_anti"), distance))
    else:
        rows = sets.select("id", *KNOWN, F.array_distinct("keys").alias("words")).select("id", *KNOWN, "words", F.posexplode("words").alias("at", "key"))
        rows = rows.select("id", *KNOWN, "key", F.slice("words", F.lit(1), F.col("at")).alias("before"))
    many = rows.join(frequent, "key", "left_semi").select("key", "id", *KNOWN, "before").distinct()
    return found, materialize(many, "large-word-keys")


def _near_pairs(rows: DataFrame, distance: int) -> DataFrame:
    a, b = _sides(rows)
    return a.join(b, "key").filter(_in_order() & _may_be_near(distance)).select("a", "b")


def _sides(rows: DataFrame, *more: str) -> list[DataFrame]:
    named = (("id", ""), *((c, f"_{c}") for c in (*KNOWN, *more)))
    on = [c for c in ("key", "block") if c in rows.columns]
    return [rows.select(*on, *(F.col(c).alias(f"{s}{t}") for c, t in named)) for s in "ab"]


def _may_be_near(distance: int) -> Column:
    """What numbers and parities of words say of two lines, of which ``a`` has no more words than ``b``."""
    most = _most_words(F.col("a_n"), distance)
    odd = [F.col(f"a_{p}").bitwiseXOR(F.col(f"b_{p}")) for p in ("p0", "p1", "p2", "p3")]
    halves, fourths = odd[:2], [odd[0].bitwiseXOR(odd[2]), odd[1].bitwiseXOR(odd[3]), *odd[2:]]
    # of lines of which one is long and one is not, only halves compare
    parities = F.when(F.col("a_n") < LONG, sum(map(F.bit_count, halves))).otherwise(sum(map(F.bit_count, fourths)))
    return (F.col("b_n") - F.col("a_n") <= most) & (parities <= most * 2)


def _in_order() -> Column:
    return (F.col("a_n") < F.col("b_n")) | (F.col("a_n") == F.col("b_n")) & (F.col("a") < F.col("b"))


def _star_pairs(held: DataFrame, leaders: list[Column], distance: int) -> DataFrame:
    """Pairs (a, b) of some lines of each key and the others that may be near them."""
    chosen = held.groupBy("key").agg(F.array_distinct(F.array(*leaders)).alias("ids")).select("key", F.explode("ids").alias("id"))
    large = large_keys(held, "key")
    lines, leaders = dealt(held, large, "key", "id"), repeated(held.join(chosen, ["key", "id"], "left_semi"), large, "key")
    found = None
    for first, second in ((leaders, lines), (lines, leaders)):
        some = _sides(first)[0].join(_sides(second)[1], ["key", "block"]).filter(_in_order() & _may_be_near(distance)).select("a", "b")
        found = some if found is None else found.union(some)
    return found.distinct()


def _cross_pairs(torn: DataFrame, distance: int, texts: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of lines of a key that may be near and that no links join so far, each under the first key that both lines have.

    With ``texts`` (id, c) only those of which the outlines ``c`` are near, so that pairs near the threshold are not written.
    The lines of a pair of which the first key is none of ``torn`` are in one component, or that key has few lines, which were all compared.
    """
    if texts is None:
        a, b = _sides(torn, "component", "before")
    else:
        a, b = _sides(torn.join(_sieved(texts.select("id", "c"), torn.select("id")), "id"), "component", "before", "c")
    # a near copy has at most a fifth more words, so it is of the same class of lengths or of the next
    size = lambda n: F.floor(F.log(F.col(n)) / F.log(F.lit(1.25)))
    a = a.withColumn("key", F.xxhash64("key", size("a_n")))
    b = b.withColumn("class", F.explode(F.array(size("b_n"), size("b_n") - 1))).withColumn("key", F.xxhash64("key", "class")).drop("class")
    large = large_keys(a, "key")
    met = dealt(a, large, "key", "a").join(repeated(b, large, "key"), ["key", "block"])
    first = ~F.arrays_overlap("a_before", "b_before")
    close = _in_order() & (F.col("a_component") != F.col("b_component")) & _may_be_near(distance) & first
    if texts is not None:
        close = close & (F.call_function("levenshtein", "a_c", "b_c", _most_words(F.col("a_n"), distance)) >= 0)
    return met.filter(close).select("a", "b").distinct()


def _torn_keys(held: DataFrame, links: DataFrame) -> DataFrame:
    """The rows of ``held`` of keys whose lines lie in several components of ``links``, with the component."""
    of = materialize(connected_components(links), "line-components").withColumnRenamed("node", "id")
    rows = held.join(of, "id", "left").withColumn("component", F.coalesce("component", "id"))
    torn = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("key")
    return rows.join(torn, "key", "left_semi")


def _confirmed(pairs: DataFrame, texts: DataFrame, distance: int) -> DataFrame:
    """The pairs (a, b) that are near by words or by code points."""
    side = lambda found, s: _sieved(texts, found.select(F.col(s).alias("id")))
    left, right = (side(pairs, s).select(F.col("id").alias(s), F.col("n").alias(f"{s}_n"), F.col("c").alias(f"{s}_c")) for s in "ab")
    few = F.call_function("div", F.least("a_n", "b_n"), F.lit(WORDS_EACH)).cast("int")
    most = _most_words(F.least("a_n", "b_n"), distance)
    # outlines are no further apart than words are
    apart = F.call_function("levenshtein", "a_c", "b_c", most)
    close = pairs.join(left, "a").join(right, "b").select("a", "b", apart.alias("apart"), few.alias("few")).filter("apart >= 0")
    close = materialize(close, "word-pairs")
    left, right = (side(close, s).select(F.col("id").alias(s), F.col("line").alias(f"{s}_line")) for s in "ab")
    both = close.join(left, "a").join(right, "b")
    v, w = _words(F.col("a_line")), _words(F.col("b_line"))
    by_words = F.when(F.col("apart") > F.col("few"), False).when(_told_apart(F.concat(v, w)), True).otherwise(_word_distance(v, w, F.col("few")))
    longer = F.char_length("a_line") >= F.char_length("b_line")
    t, s = F.when(longer, F.col("a_line")).otherwise(F.col("b_line")), F.when(longer, F.col("b_line")).otherwise(F.col("a_line"))
    return both.filter(by_words | _near_by_chars(t, s, distance)).select("a", "b").distinct()


def duplicate_lines(docs: DataFrame, distance: int = DISTANCE, least: int = LEAST_CHARS, by_words: bool = False) -> DataFrame:
    """doc_id and the numbers (from 0) of its lines that repeat an earlier line of the corpus, exactly or nearly.

    Near copies are lines within ``distance`` code points and, with ``by_words``, long lines that differ in few words.
    Of each group of lines that are linked, directly or through others, the first stays: that of the smallest
    doc_id, in it the first. Lines under ``least`` code points or without a visible character are left
    alone, as are rows with a null doc_id or text; lines under LEAST_CHARS repeat equal ones only. Repeated rows of one doc_id count once. Only documents
    with such lines have a row.
    """
    lines = occurrences(docs, least)
    classes = materialize(line_classes(lines), "line-classes")
    # lines within two code points differ by two in their number of words at most
    fewer = MANY_WORDS + 2 if by_words and distance <= 2 else None
    links = settled("line-links", lambda: similar_lines(lines, classes, distance, fewer))
    if by_words:
        links = links.union(settled("line-links", lambda: similar_by_words(lines, classes, distance)))
    groups = settled("line-groups", lambda: connected_components(links)).withColumnRenamed("node", "id")
    known = classes.withColumnRenamed("first", "pos").join(groups, "id", "left")
    linked = known.filter("component is not null")
    firsts = linked.groupBy("component").agg(F.min("pos").alias("first"))
    near = linked.join(firsts, "component").select("id", "id2", "first")
    equal = known.filter("component is null and held > 1").select("id", "id2", F.col("pos").alias("first"))
    repeated = materialize(near.union(equal), "repeated-lines")
    gone = lines.select("doc_id", "line_no", "id", "id2", "pos").join(repeated, ["id", "id2"]).filter("pos <> first")
    return gone.groupBy("doc_id").agg(F.array_sort(F.collect_set("line_no")).alias("removed"))  # bounded by one text


def line_report(docs: DataFrame, distance: int = DISTANCE, least: int = LEAST_CHARS, by_words: bool = False) -> DataFrame:
    """For every row of ``docs``: doc_id, its number of lines and the numbers of those that repeat earlier ones."""
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).alias("n_lines"))
    counted = counted.withColumn("n_lines", F.greatest("n_lines", F.lit(0)))
    found = counted.join(duplicate_lines(docs, distance, least, by_words), "doc_id", "left")
    removed = F.coalesce("removed", F.expr("cast(array() as array<int>)"))
    return found.select("doc_id", "n_lines", F.size(removed).alias("n_removed"), removed.alias("removed"))


def dedup_lines(docs: DataFrame, distance: int = DISTANCE, least: int = LEAST_CHARS, by_words: bool = False) -> DataFrame:
    """``docs`` with repeated lines taken out of the texts; a document that loses all its text goes.

    All columns stay. Documents that had no text before stay as they are.
    """
    removed = duplicate_lines(docs, distance, least, by_words).select(F.col("doc_id").alias("key"), "removed")
    # the row travels as one value, so its other columns may have any names
    whole = docs.select(F.col("doc_id").cast("long").alias("key"), F.col("text"), F.struct("*").alias("row"))
    joined = whole.join(removed, "key", "left")
    kept = F.filter(F.split("text", "\n", -1), lambda line, k: ~F.array_contains(F.col("removed"), k))
    text = F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    cut = joined.select("removed", text.alias("text"), "row").filter(F.col("removed").isNull() | F.col("text").rlike(r"\S"))
    return cut.select(F.col("row").withField("text", F.col("text")).alias("row")).select("row.*")
