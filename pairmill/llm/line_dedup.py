"""Line deduplication by a segment-partition edit join (operator 4). DataFrame functions only.

A line goes when an earlier line (smaller doc_id, then row, then line number) is equal to
it or at most `edits` code-point edits away. Whether the earlier one goes too makes no
difference. Lines shorter than `min_chars` stay.

Equal lines are found by two hashes. Of each different line, the first place cuts it into
`edits + 1` segments: if two lines are within `edits`, one has a segment of the other
unchanged, near the same place. Segments are indexed by length of their line, number and
text; a line probes the substrings that can match for each length (from the left and from
the right, an edit may have moved a segment by as many signs only as there are edits on
that side). Lines that meet are verified with a bit-parallel edit distance in a band.

Lines of a large group of near copies differ in a word or two and share segments with all
of the group. In a segment of more than `CROWD` lines they meet under second keys that all
lines within `edits` share, so no pair is lost; a line makes a bounded number of them. If the
edits are replacements alone, no sign moves, and one of `edits + 1` classes of places has the
same signs in both lines. Else at least one edit inserts or deletes and touches one class of
signs, where a replacement touches two: of `2 * edits` classes some are equal, as many as the
lengths of the lines tell.

Defined cases: a null text stays null and an empty one empty; each row is a document of its
own, under a row key stored with it, so of rows that repeat a doc_id the one with the
smaller row key comes first; a null doc_id comes after all others; a document that loses all
lines stays with an empty text in `dedup`, and goes in `keep_lines` if it had a word before;
columns keep their names, whatever they are; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmill.llm.common import lookup
from pairmill.session import durable

EDITS = 2
MIN_CHARS = 20
LAST_ID = (1 << 63) - 1

# In a segment with more lines than these, and index lines than a quarter of it, they meet under
# second keys; it changes no result. Other segments make that many pairs at most for each line.
CROWD = 16


def _own(listed: str) -> Column:
    """Of the listed `line_no, h`, the line numbers whose line is that one in this row."""
    mine = F.filter(listed, lambda x: F.xxhash64(F.get("_split", x["line_no"])) == x["h"])
    return F.transform(mine, lambda x: x["line_no"])


def _picked(rows: DataFrame, numbers: Column) -> DataFrame:
    """`line_no, line`: the lines of `_split` with the given numbers."""
    each = F.transform(
        numbers, lambda i: F.struct(i.alias("line_no"), F.get("_split", i).alias("line"))
    )
    return rows.select(F.inline(each))


def _different(rows: DataFrame, listed: str) -> DataFrame:
    """The lines of each document but for the listed ones."""
    split = rows.withColumn("_split", F.coalesce(F.split("text", "\n"), F.array(F.lit(""))))
    numbers = F.sequence(F.lit(0), F.size("_split") - 1)
    gone = F.coalesce(_own(listed), F.array().cast("array<int>"))
    return _picked(split, F.array_except(numbers, gone))


def _segment(n: Column, i: Column, edits: int) -> tuple[Column, Column]:
    """Start (from 1) and length of segment i of a line of n signs; later ones are longer."""
    parts = edits + 1
    base, more = F.floor(n / parts).cast("int"), n % parts
    start = base * (i - 1) + F.greatest(F.lit(0), more + i - (parts + 1)) + 1
    return start, base + F.when(more + i >= parts + 1, 1).otherwise(0)


def segment_places(edits: int) -> list[dict[str, int]]:
    """Where a line is cut for its keys: segment i of lines `delta` signs shorter, moved by `shift`.

    Role 0 is an index key (and a probe for lines as long); 1 + d probes for lines d signs shorter.
    """
    return [
        {"delta": delta, "i": i, "shift": shift, "role": 0 if delta == shift == 0 else delta + 1}
        for delta in range(edits + 1)
        for i in range(1, edits + 2)
        for shift in range(1 - i, i)
        if abs(shift - delta) <= edits + 1 - i
    ]


def segment_keys(sized: DataFrame, edits: int) -> DataFrame:
    """`k, h, role`: the keys under which `line, h, n` rows are indexed and probe.

    The places are rows, so that one key's code serves all of them. The code of all keys side by
    side is a method longer than the JVM compiles.
    """
    places = F.array(
        *[F.struct(*[F.lit(v).alias(name) for name, v in place.items()]) for place in segment_places(edits)]
    )
    size = F.col("n") - F.col("delta")
    start, length = _segment(size, F.col("i"), edits)
    start = start + F.col("shift")
    cut = sized.select("line", "h", "n", F.inline(places)).where((start >= 1) & (start + length - 1 <= F.col("n")))
    key = F.xxhash64("i", size, F.substring("line", start, length))
    return cut.select(key.alias("k"), "h", "role")


def _automaton(a: Column, b: Column, edits: int, steps: Column) -> Column:
    """State after that many signs of b, one step for each.

    Bit t of vector e says that the prefixes of b of length j and of a of length
    j + t - edits are at most e edits apart.
    """
    everything = (1 << (2 * edits + 1)) - 1
    start = F.struct(
        *[F.lit(sum(1 << (edits + d) for d in range(e + 1))).alias(f"r{e}") for e in range(edits + 1)]
    )

    def moved(state: Column, match: Column) -> Column:
        made: list[Column] = [state["r0"].bitwiseAND(match)]
        for e in range(1, edits + 1):
            less = state[f"r{e - 1}"]
            kept = state[f"r{e}"].bitwiseAND(match)
            inserted = F.shiftright(less, 1)
            deleted = F.shiftleft(made[-1], 1).bitwiseAND(everything)
            made.append(kept.bitwiseOR(less).bitwiseOR(inserted).bitwiseOR(deleted))
        return F.struct(*[r.alias(f"r{e}") for e, r in enumerate(made)])

    def step(state: Column, j: Column) -> Column:
        sign = F.get(b, j)
        match = F.lit(0)
        for t in range(2 * edits + 1):
            same = F.coalesce(F.get(a, j + (t - edits)) == sign, F.lit(False))
            match = match + F.when(same, 1 << t).otherwise(0)
        # As the element of a list the matches are computed once.
        return F.get(F.transform(F.array(match), lambda m: moved(state, m)), F.lit(0))

    places = F.when(steps > 0, F.sequence(F.lit(0), steps - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(places, start, step)


def may_be_close(a: Column, b: Column, edits: int, steps: int = 24) -> Column:
    """False if the first signs of two arrays alone need more edits."""
    state = _automaton(a, b, edits, F.least(F.size(b), F.lit(steps)))
    return state[f"r{edits}"] != 0


def edit_distance(a: Column, b: Column, edits: int) -> Column:
    """Edits between two arrays of signs; `edits + 1` if there are more."""
    place = F.size(a) - F.size(b) + edits
    bit = F.call_function("shiftleft", F.lit(1), place)
    state = _automaton(a, b, edits, F.size(b))
    found = F.lit(edits + 1)
    for e in reversed(range(edits + 1)):
        found = F.when(state[f"r{e}"].bitwiseAND(bit) != 0, e).otherwise(found)
    return F.when(F.abs(F.size(a) - F.size(b)) <= edits, found).otherwise(edits + 1)


def _alike(a: Column, b: Column, size: Column, at_end: bool, before: Column) -> Column:
    """Signs that two texts share at one end, by halving steps; of a very long text a part."""
    n, m = F.length(a), F.length(b)

    def more(known: Column, step: Column) -> Column:
        if at_end:
            x, y = F.substring(a, n - known - step + 1, step), F.substring(b, m - known - step + 1, step)
        else:
            x, y = F.substring(a, known + 1, step), F.substring(b, known + 1, step)
        return F.when((before + known + step <= size) & (x == y), known + step).otherwise(known)

    return F.aggregate(F.array(*[F.lit(1 << i) for i in range(13, -1, -1)]), F.lit(0), more)


def different_parts(rows: DataFrame, a: str, b: str) -> DataFrame:
    """Replace texts a and b by the signs between their common beginning and end."""
    least = F.least(F.length(a), F.length(b))
    headed = rows.withColumn("_p", _alike(F.col(a), F.col(b), least, False, F.lit(0)))
    both = headed.withColumn("_q", _alike(F.col(a), F.col(b), least, True, F.col("_p")))
    inner = lambda c: _signs(F.substring(c, F.col("_p") + 1, F.length(c) - F.col("_p") - F.col("_q")))
    return both.withColumns({a: inner(F.col(a)), b: inner(F.col(b))}).drop("_p", "_q")


def _signs(line: Column) -> Column:
    return F.filter(F.split(line, ""), lambda c: c != "")


def class_hashes(line: Column, edits: int) -> tuple[Column, Column]:
    """Hashes of the signs at each class of places, and of those of each class of signs, in order."""
    signs, classes = _signs(line), 2 * edits

    def at_places(i: int) -> Column:
        return F.xxhash64(F.lit(i), F.filter(signs, lambda _, at: at % (edits + 1) == i))

    def of_signs(i: int) -> Column:
        mine = lambda c: F.pmod(F.pmod(F.ascii(c), F.lit(23)), F.lit(classes)) == i
        return F.xxhash64(F.lit(i), F.filter(signs, mine))

    places = F.array(*[at_places(i) for i in range(edits + 1)])
    return places, F.array(*[of_signs(i) for i in range(classes)]).cast("array<bigint>")


def second_keys(places: Column, signs: Column, edits: int) -> tuple[list[Column], dict[int, list[Column]]]:
    """What a line may share with one within `edits`: places, and as many classes of signs as given.

    A list of classes is one list for all lengths of the other line, so it is made once.
    """
    at_places = [F.xxhash64(F.lit(-1 - i), F.get(places, F.lit(i))) for i in range(edits + 1)]
    of_signs = {
        equal: [
            F.xxhash64(F.lit(equal), F.lit(j), *[F.get(signs, F.lit(i)) for i in chosen])
            for j, chosen in enumerate(combinations(range(2 * edits), equal))
        ]
        for equal in range(1, edits + 1)
    }
    return at_places, of_signs


def equal_classes(delta: int) -> int:
    """Classes of signs that are equal at least in lines within the edits, one `delta` signs longer.

    `delta` edits at least insert or delete; two, if there are any in lines of one length.
    Of 2 * edits classes 2 * edits less their number may be touched.
    """
    return delta or 2


def _meet(rows: DataFrame) -> DataFrame:
    """`a, b`: lines of which one probes the other's index key, for `k, h, is_index, probes` rows."""
    return (
        rows.where("is_index").select("k", F.col("h").alias("a"))
        .join(rows.where("probes").select("k", F.col("h").alias("b"), "is_index"), "k")
        .where("a <> b and (not is_index or a < b)")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )


def _second_rows(rows: DataFrame, hashed: DataFrame, edits: int) -> DataFrame:
    """`k, h, is_index, probes`: the second keys of `k, h, role` rows."""
    at_places, of_signs = second_keys(F.col("places"), F.col("classes"), edits)
    entry = lambda key, is_index, probes: F.struct(
        key.alias("mark"), F.lit(is_index).alias("is_index"), F.lit(probes).alias("probes")
    )
    # An index line has keys for partners of each length, and probes those of its own length.
    own = [entry(key, True, True) for key in at_places]
    own += [entry(key, True, n == equal_classes(0)) for n, keys in of_signs.items() for key in keys]
    entries = F.when(F.col("role") == 0, F.array(*own))
    # A probe for its own length has moved by a sign or more, so edits insert and delete.
    for delta in range(edits + 1):
        if keys := of_signs.get(equal_classes(delta)):
            entries = entries.when(F.col("role") == delta + 1, F.array(*[entry(key, False, True) for key in keys]))
    narrow = rows.join(hashed, "h").select("k", "h", F.inline(entries))
    return narrow.select(F.xxhash64("k", "mark").alias("k"), "h", "is_index", "probes")


def _meet_in_crowds(rows: DataFrame, signs: DataFrame, edits: int) -> DataFrame:
    """`a, b`: of `k, h, role` rows those lines that also share a second key."""
    chosen = signs.join(rows.select("h").distinct(), "h", "left_semi")
    places, classes = class_hashes(F.col("line"), edits)
    hashed = durable(chosen.select("h", places.alias("places"), classes.alias("classes")), "class-hashes")
    # The keys are made and dealt once, and only those that lines share are stored.
    dealt = _second_rows(rows, hashed, edits).repartition("k")
    shared = dealt.groupBy("k").agg(
        F.min("h").alias("low"),
        F.max("h").alias("high"),
        F.max("is_index").alias("indexed"),
        F.max("probes").alias("probed"),
    )
    shared = shared.where("low <> high and indexed and probed").select("k")
    return _meet(durable(dealt.join(shared.hint("shuffle_hash"), "k"), "shared-second-keys"))


def _by_row(places: DataFrame) -> DataFrame:
    """`row, _listed`: each row's lines among these; they fit in it."""
    return places.groupBy("row").agg(F.collect_list(F.struct("line_no", "h")).alias("_listed"))


def _few_new_words(a: Column, b: Column, edits: int) -> Column:
    """Can the lines be so close? An edit touches two words at most."""
    return F.size(F.array_except(F.split(a, " "), F.split(b, " "))) <= 2 * edits


def removed_lines(
    docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, crowd: int = CROWD
) -> DataFrame:
    """`row, _listed`: the lines to remove from each row, for stored `row, doc_id, text` rows."""
    if min_chars <= edits:
        raise ValueError("lines must be longer than the number of edits")
    lines = docs.select("doc_id", "row", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    hashes = {"h": F.xxhash64("line"), "g": F.xxhash64(F.lit(7), "line")}
    long = F.length("line") >= min_chars
    # `at` grows with the row, then with the line.
    places = lines.withColumn("at", F.monotonically_increasing_id()).where(long)
    places = durable(
        places.select("doc_id", "row", "line_no", "at", *[c.alias(n) for n, c in hashes.items()]), "lines"
    )
    # The first place of each different line: documents first, then rows, then lines.
    per_doc = places.groupBy("h", "g", "doc_id").agg(
        F.min("at").alias("at"),
        F.min_by("row", "at").alias("row"),
        F.min_by("line_no", "at").alias("line_no"),
        F.count(F.lit(1)).alias("n"),
    )
    firsts = per_doc.groupBy("h", "g").agg(
        F.min("doc_id").alias("first_doc"),
        F.min_by("at", "doc_id").alias("first_at"),
        F.min_by("row", "doc_id").alias("first_row"),
        F.min_by("line_no", "doc_id").alias("first_line"),
        F.sum("n").alias("n"),
    )
    firsts = durable(firsts, "first-lines")
    many = durable(firsts.where("n > 1").select("h", "g", "first_doc", "first_at"), "repeated-lines")
    later = lookup(places, many, ["h", "g"], "inner").where(
        "doc_id > first_doc or (doc_id = first_doc and at > first_at)"
    )
    repeats = durable(_by_row(later), "repeats")

    # Index and probes of the different lines, in one shuffle.
    different = _different(lookup(docs, repeats, ["row"]), "_listed").where(long)
    sized = different.select("line", F.xxhash64("line").alias("h"), F.length("line").alias("n"))
    rows = segment_keys(sized, edits).repartition("k")
    shared = rows.groupBy("k").agg(
        F.min("h").alias("low"),
        F.max("h").alias("high"),
        F.sum((F.col("role") == 0).cast("int")).alias("indexed"),
        F.count(F.lit(1)).alias("n"),
    )
    crowded = (F.col("n") > crowd) & (F.col("indexed") > crowd // 4)
    shared = shared.where("low <> high and indexed > 0").withColumn("crowded", crowded).select("k", "crowded")
    met = durable(rows.join(shared.hint("shuffle_hash"), "k"), "shared-segments")

    # Texts of the lines that meet another one, from their first places.
    wanted = met.select("h").distinct().join(firsts, "h")
    wanted = wanted.select(F.col("first_row").alias("row"), F.col("first_line").alias("line_no"), "h")
    chosen = durable(_by_row(wanted), "lines-to-verify")
    texts = lookup(docs, chosen, ["row"], "inner").withColumn("_split", F.split("text", "\n"))
    signs = (
        _picked(texts, _own("_listed"))
        .select(*[c.alias(n) for n, c in hashes.items()], "line")
        .dropDuplicates(["h", "g"])
    )
    signs = durable(signs, "line-texts")

    few = met.where("not crowded").select("k", "h", (F.col("role") == 0).alias("is_index"), F.lit(True).alias("probes"))
    many = _meet_in_crowds(met.where("crowded"), signs, edits)
    pairs = durable(_meet(few).union(many).distinct(), "line-pairs")
    side = lambda name: signs.select(
        F.col("h").alias(name), F.col("g").alias(f"{name}_g"), F.col("line").alias(f"{name}_s")
    )
    near = (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .where(_few_new_words(F.col("a_s"), F.col("b_s"), edits))
        .where(_few_new_words(F.col("b_s"), F.col("a_s"), edits))
    )
    close = durable(different_parts(near, "a_s", "b_s"), "different-parts")
    x, y = F.col("a_s"), F.col("b_s")
    close = durable(close.repartition("a", "b").where(may_be_close(x, y, edits)), "close-lines")
    near = (
        close.where(edit_distance(x, y, edits) <= edits)
        .select(
            F.struct(F.col("a").alias("h"), F.col("a_g").alias("g")).alias("x"),
            F.struct(F.col("b").alias("h"), F.col("b_g").alias("g")).alias("y"),
        )
    )
    near = durable(near, "near-lines")
    both = near.union(near.select("y", "x"))
    place = F.struct("first_doc", "first_at")
    at = firsts.select(F.struct("h", "g").alias("x"), place.alias("x_at"))
    other = firsts.select(F.struct("h", "g").alias("y"), place.alias("y_at"))
    late = both.join(at, "x").join(other, "y").where("y_at < x_at").select("x.h", "x.g").distinct()
    late = durable(late, "late-lines")
    edited = lookup(places, late, ["h", "g"], "inner")
    everything = edited.select("row", "line_no", "h").union(later.select("row", "line_no", "h"))
    return durable(_by_row(everything), "removed-lines")


def dedup(
    docs: DataFrame, text: str = "text", key: str = "doc_id", edits: int = EDITS,
    min_chars: int = MIN_CHARS, crowd: int = CROWD,
) -> DataFrame:
    """`doc` (the row as it came), `kept` (its text without the lines), `n_lines, n_removed`."""
    # Row keys are stored with the rows: a replay could number them anew.
    rows = docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row"))
    rows = durable(rows, "keyed-documents")
    ids = F.coalesce(F.col("doc").getField(key).cast("bigint"), F.lit(LAST_ID)).alias("doc_id")
    removed = removed_lines(
        rows.select("row", ids, F.col("doc").getField(text).alias("text")), edits, min_chars, crowd
    )
    rows = rows.withColumn("text", F.col("doc").getField(text))
    split = lookup(rows, removed, ["row"]).withColumn("_split", F.split("text", "\n"))
    numbered = split.withColumn("_gone", F.when(F.col("_listed").isNotNull(), _own("_listed")))
    numbers = F.array_except(F.sequence(F.lit(0), F.size("_split") - 1), F.col("_gone"))
    kept = F.array_join(F.transform(numbers, lambda i: F.get("_split", i)), "\n")
    return numbered.select(
        "doc",
        F.when(F.size("_gone") > 0, kept).otherwise(F.col("text")).alias("kept"),
        F.greatest(F.size("_split"), F.lit(0)).cast("bigint").alias("n_lines"),
        F.greatest(F.size("_gone"), F.lit(0)).cast("bigint").alias("n_removed"),
    )


def keep_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The documents with the remaining text, and the columns they came with.

    A document whose removed lines held all its words goes; one that came without a word stays.
    """
    done = dedup(docs, text, key, **options)
    word = "[^\\x20\\x09-\\x0D]"
    emptied = ~F.col("kept").rlike(word) & F.col("doc").getField(text).rlike(word)
    return done.where((F.col("n_removed") == 0) | ~emptied).select(
        *[
            F.col("kept").alias(c) if c == text else F.col("doc").getField(c).alias(c)
            for c in docs.columns
        ]
    )
