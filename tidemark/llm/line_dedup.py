"""Lines that repeat an earlier line of the corpus, up to an edit of one word."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import BETWEEN_WORDS, let, small, stage

#: Words from which a line can be an edited repeat: of these, two are then equal.
MIN_EDITED = 3
#: Sums of hashes are kept to this many bits, so that they cannot overflow.
_BITS = (1 << 60) - 1
#: What a variant is a key of: the whole line, the line closed up without a word, or with a place left open.
_WHOLE, _GAP, _HOLE = 0, 1, 2


def _words(line: Column) -> Column:
    return F.array_remove(F.split(F.lower(line), BETWEEN_WORDS), "")


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, tag (a hash of the text), line_no and words of each line with a word."""
    return (
        docs.select(
            docs["doc_id"].alias("doc_id"), F.xxhash64(docs["text"]).alias("tag"),
            F.posexplode(F.split(docs["text"], "\n")).alias("line_no", "line"),
        )
        # A test of the line, not of its words, which would be split twice.
        .where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
        .select("doc_id", "tag", "line_no", _words(F.col("line")).alias("words"))
    )


def _half_keys(words: Column) -> Column:
    """Four keys of which lines one word apart share one: equal first or last halves.

    The half is taken of the shorter line's number of words, which is that of this line or one
    less.
    """
    n = F.size(words)
    keys = []
    for shorter in (n, n - 1):
        half = F.floor(shorter / 2).cast("int")
        keys.append(F.xxhash64(F.lit(0), shorter, F.slice(words, F.lit(1), half)))
        keys.append(F.xxhash64(F.lit(1), shorter, F.slice(words, n - half + 1, half)))
    return F.array(*keys)


def _plus(a: Column, b: Column) -> Column:
    return (a + b).bitwiseAND(_BITS)


def _running(values: Column) -> Column:
    """0 and the sums of the values up to each, in time that grows with the square of their number."""
    zero = F.array(F.lit(0).cast("bigint"))
    return F.aggregate(values, zero, lambda sums, x: F.concat(sums, F.array(_plus(F.element_at(sums, -1), x))))


def _prefix_sums(values: Column) -> Column:
    """The sums of the values before each place, and of all.

    Sums are built within blocks and over the blocks.  These are as long as costs least, so a very
    long line takes little more than its length.
    """

    def of_blocks(blocks: Column) -> Column:
        offsets = _running(F.transform(blocks, lambda sums: F.element_at(sums, -1)))
        return let(offsets, lambda o: F.concat(
            F.flatten(F.transform(blocks, lambda sums, b: F.transform(
                F.slice(sums, F.lit(1), F.size(sums) - 1), lambda x: _plus(x, o[b])
            ))),
            F.array(F.element_at(o, -1)),
        ))

    def of_values(v: Column) -> Column:
        block = F.ceil(F.cbrt(2 * F.size(v))).cast("int")
        return let(block, lambda n: let(
            F.transform(F.sequence(F.lit(1), F.size(v), n), lambda at: _running(F.slice(v, at, n))), of_blocks
        ))

    return let(values, of_values)


def _at(word: Column, place: Column) -> Column:
    return F.xxhash64(word, place).bitwiseAND(_BITS)


def _variants(candidates: DataFrame) -> DataFrame:
    """ord, kind and key of the line itself and of the line without each of its words.

    A key is a hash of a sequence of words with their places.  `whole` is the line; `gap` the
    line without a word, closed up, which is equal to the whole of a line that lacks it; `hole`
    the line with one place left open, equal to that of a line with another word there.  Two lines
    that differ at a place share the half key of the other half, so variants are built only where
    `shared` (a bit for each half key) says that another line has that half.
    """
    # The sums of all places are built once; the keys are then plain arithmetic for each place.
    here = F.transform("words", lambda x, i: _at(x, i))
    # What a word adds if it moves up by one.
    moved = F.transform("words", lambda x, i: _at(x, i - 1))
    lines = candidates.select(
        "ord", "shared", F.size("words").alias("n"), here.alias("here"),
        _prefix_sums(here).alias("before"), _prefix_sums(moved).alias("after"),
    )
    n, i = F.col("n"), F.col("i")
    total = F.col("before")[n]
    whole = lines.where(F.col("shared").bitwiseAND(3) != 0).select(
        "ord", F.lit(_WHOLE).alias("kind"), F.xxhash64(F.lit(0), n, total).alias("key")
    )

    def other_half(length: Column, first_bit: int) -> Column:
        """Whether another line has the half of a line of that length in which place i is not."""
        in_second = i >= F.floor(length / 2).cast("int")
        return F.when(in_second, F.col("shared").bitwiseAND(first_bit)).otherwise(F.col("shared").bitwiseAND(2 * first_bit)) != 0

    hole = F.xxhash64(F.lit(1), n, i, _plus(total, F.lit(_BITS + 1) - F.col("here")[i]))
    # What stands before the place, and what moves up: all after it.
    gap = F.xxhash64(F.lit(0), n - 1, _plus(F.col("before")[i], _plus(F.col("after")[n], F.lit(_BITS + 1) - F.col("after")[i + 1])))
    places = lines.withColumn("i", F.explode(F.sequence(F.lit(0), n - 1)))
    keys = F.array(F.when(other_half(n - 1, 4), gap), F.when(other_half(n, 1), hole))
    edited = places.select("ord", F.posexplode(keys).alias("kind", "key")).where("key IS NOT NULL")
    return whole.unionByName(edited.withColumn("kind", F.col("kind") + _GAP))


def _one_apart(a: Column, b: Column) -> Column:
    """Whether one edit of a word, at most, makes a of b; in time that grows with their length."""

    def common(x: Column, y: Column) -> Column:
        differs = F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), False).cast("int")
        return F.when(differs > 0, differs - 1).otherwise(F.size(x))

    longer = F.greatest(F.size(a), F.size(b))
    return (F.abs(F.size(a) - F.size(b)) <= 1) & (
        common(a, b) + common(F.reverse(a), F.reverse(b)) >= longer - 1
    )


def repeated_lines(docs: DataFrame) -> DataFrame:
    """doc_id, line_no, first_doc_id, first_line_no, edits of each line that repeats an earlier one.

    Lines are split at \\n and compared by their lower-cased words.  Earlier is a line of a smaller
    doc_id, or of the same document with a smaller line_no (from 0).  A line with a word repeats
    an earlier one of equal words; one of MIN_EDITED words or more also an earlier one, as long,
    from which one word differs, is missing or is added.  first_... is the earliest of these, and
    edits is 0 if it is equal, else 1.  A line counts as repeated also where the earlier one is
    itself a repeat.  Lines without a word are never repeats.  A null text has no lines; a null
    doc_id is before all others.  Rows of one doc_id are ordered by a hash of their text, and lines
    of rows equal in both are at one place, so none repeats the other.  An empty table gives no
    rows; other columns of docs are left out.

    Equal lines are one class first.  Every class emits its four half keys; those that share one
    with another class, of which there are few, emit their variants on that side, which are joined
    as equal keys: of each key only the earliest line is handed back, so that a group of many
    similar lines makes no pairs.  The earliest partner's words are then compared.  Keys are
    64-bit hashes, of lines 128 bits.
    """
    place = F.struct("doc_id", "tag", "line_no")
    lines = stage(
        _lines(docs).select(
            place.alias("place"),
            F.xxhash64("words").alias("k1"), F.xxhash64(F.lit(1), "words").alias("k2"),
            F.when(F.size("words") >= MIN_EDITED, _half_keys(F.col("words"))).alias("halves"),
        ),
        "lines",
    )
    classes = stage(
        lines.groupBy("k1", "k2").agg(
            F.min("place").alias("first"), F.max("place").alias("last"), F.first("halves").alias("halves")
        ),
        "classes",
    )
    halves = classes.select("k1", F.posexplode("halves").alias("bit", "half"))
    shared = halves.groupBy("half").agg(F.min("k1").alias("low"), F.max("k1").alias("high")).where("low <> high")
    chosen = halves.join(shared.select("half"), "half").groupBy("k1").agg(
        F.bit_or(F.expr("shiftleft(1, bit)")).alias("shared")
    )
    wanted = small(
        classes.select("k1", "k2", "first").join(chosen, "k1")
        .groupBy(F.col("first.doc_id").alias("id"), F.col("first.tag").alias("its_tag"))
        .agg(F.collect_list(F.struct("k1", "k2", "first.line_no", "shared")).alias("its_lines"))
    )
    text = docs.select(docs["doc_id"].alias("doc_id"), F.xxhash64(docs["text"]).alias("tag"), docs["text"].alias("text"))
    picked = let(F.split("text", "\n"), lambda all_lines: F.transform("its_lines", lambda one: F.struct(
        one["k1"].alias("k1"), one["k2"].alias("k2"), one["line_no"].alias("line_no"), one["shared"].alias("shared"),
        all_lines[one["line_no"]].alias("line"),
    )))
    # One row a class, in the order of their places: ord grows with them.
    candidates = stage(
        text.join(wanted, text["doc_id"].eqNullSafe(F.col("id")) & (F.col("tag") == F.col("its_tag")))
        .select("doc_id", "tag", F.explode(picked).alias("one")).select("doc_id", "tag", "one.*")
        .dropDuplicates(["k1", "k2"])
        .select("k1", "k2", "shared", place.alias("first"), F.transform(_words(F.col("line")), lambda word: F.xxhash64(word)).alias("words"))
        .repartitionByRange("first").sortWithinPartitions("first")
        .withColumn("ord", F.monotonically_increasing_id()),
        "candidates",
    )
    variants = stage(_variants(candidates), "variants")
    earliest = small(
        variants.groupBy("key").agg(
            F.count("*").alias("n"),
            *[F.min(F.when(F.col("kind") == kind, F.col("ord"))).alias(f"first{kind}") for kind in (_WHOLE, _GAP, _HOLE)],
        ).where("n > 1").drop("n")
    )
    partner = (
        F.when(F.col("kind") == _WHOLE, F.col(f"first{_GAP}"))
        .when(F.col("kind") == _GAP, F.col(f"first{_WHOLE}"))
        .otherwise(F.col(f"first{_HOLE}"))
    )
    met = stage(
        variants.join(earliest, "key").select("ord", partner.alias("partner")).where("partner < ord")
        .groupBy("ord").agg(F.min("partner").alias("partner")),
        "met",
    )
    earlier = candidates.select(F.col("ord").alias("partner"), F.col("first").alias("source"), F.col("words").alias("its_words"))
    near = (
        met.join(candidates, "ord").join(earlier, "partner")
        .where(_one_apart(F.col("words"), F.col("its_words")))
        .select(F.col("k1").alias("n1"), F.col("k2").alias("n2"), F.col("first").alias("own"), "source")
    )
    equal = classes.where("first < last").select("k1", "k2", "first")
    again = equal.join(near, (F.col("k1") == F.col("n1")) & (F.col("k2") == F.col("n2")), "full").select(
        F.coalesce("k1", "n1").alias("k1"), F.coalesce("k2", "n2").alias("k2"),
        F.coalesce("first", "own").alias("first"), F.coalesce("source", "first").alias("source"),
    )
    return (
        lines.select("k1", "k2", "place").join(again, ["k1", "k2"]).where("source < place")
        .select(
            F.col("place.doc_id").alias("doc_id"), F.col("place.tag").alias("tag"),
            F.col("place.line_no").cast("long").alias("line_no"),
            F.col("source.doc_id").alias("first_doc_id"),
            F.col("source.line_no").cast("long").alias("first_line_no"),
            F.when(F.col("source") == F.col("first"), 0).otherwise(1).alias("edits"),
        )
    )


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """docs without its `repeated_lines`; the columns stay, n_chars (if any) follows the text.

    A document that had words and has none left is left out: all that it says is in earlier
    ones.  A document without words, or without repeated lines, stays as it is.
    """
    repeated = repeated_lines(docs).groupBy(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag")).agg(
        F.collect_set(F.col("line_no").cast("int")).alias("_gone")
    )
    rest = let(F.split(docs["text"], "\n"), lambda lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone")), lambda i: lines[i]
    ), "\n"))
    text = F.when(F.col("_gone").isNull(), docs["text"]).otherwise(rest)
    joined = docs.join(
        repeated, docs["doc_id"].eqNullSafe(F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_tag")), "left"
    ).select(*[docs[c] for c in docs.columns if c != "text"], text.alias("text"), F.col("_gone").isNull().alias("_same"))
    left = joined.where(F.col("_same") | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    columns = [
        F.char_length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`")
        for c in docs.columns
    ]
    return left.select(*columns)


def oracle_sql() -> str:
    """The rows of `repeated_lines` in plain SQL for documents with different doc_ids, by the words themselves."""
    return (
        "WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),"
        " l0 AS (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS line_no FROM s),"
        " l AS (SELECT doc_id, line_no, regexp_extract_all(lower(line), '[^\\x20\\x09-\\x0D]+') AS w FROM l0),"
        f" k AS (SELECT doc_id, line_no, w, (doc_id * 1000000 + line_no) AS place FROM l WHERE len(w) >= 1),"
        " c AS (SELECT w, min(place) AS first FROM k GROUP BY w),"
        f" p AS (SELECT w, first, unnest(range(len(w))) AS i FROM c WHERE len(w) >= {MIN_EDITED}),"
        " v AS (SELECT first, i, array_to_string(w[1:i], ' ') || ' ' || array_to_string(w[i + 2:], ' ') AS gap,"
        " array_to_string(list_concat(w[1:i], w[i + 2:]), ' ') AS closed, len(w) AS n FROM p),"
        f" c8 AS (SELECT array_to_string(w, ' ') AS whole, first FROM c WHERE len(w) >= {MIN_EDITED}),"
        " hole AS (SELECT v.first AS first, m.first AS partner FROM v JOIN"
        " (SELECT i, gap, n, min(first) AS first FROM v GROUP BY i, gap, n) m"
        " ON v.i = m.i AND v.gap = m.gap AND v.n = m.n),"
        " less AS (SELECT v.first AS first, c8.first AS partner FROM v JOIN c8 ON v.closed = c8.whole),"
        " near AS (SELECT first, min(partner) AS partner FROM (SELECT * FROM hole UNION ALL SELECT * FROM less"
        " UNION ALL SELECT partner AS first, first AS partner FROM less) WHERE partner < first GROUP BY first),"
        " source AS (SELECT c.w AS w, c.first AS first, coalesce(near.partner, c.first) AS source"
        " FROM c LEFT JOIN near ON near.first = c.first)"
        " SELECT k.doc_id AS doc_id, k.line_no AS line_no, source // 1000000 AS first_doc_id,"
        " source % 1000000 AS first_line_no, CASE WHEN source = first THEN 0 ELSE 1 END AS edits"
        " FROM k JOIN source ON k.w = source.w WHERE source < place"
    )
