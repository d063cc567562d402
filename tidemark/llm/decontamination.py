"""Documents that hold passages of a benchmark, found by spaced seeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import fits_broadcast, small, stage, words_of

#: Words of an overlap, and how many of them must be equal at the same place.
OVERLAP, EQUAL_PERCENT = 13, 80
#: For overlaps of so many words the masks: the places that a seed compares; it ignores the others.
#: However the allowed words are replaced, some place of some mask leaves them all out, so every
#: overlap holds an equal seed (the tests try all replacements).  An item of fewer words than
#: OVERLAP is one overlap; of four words or fewer none may be replaced.
MASKS = {
    13: ((0, 1, 2, 3, 4, 6), (0, 1, 3, 8, 9, 10)),
    12: ((0, 1, 2, 3, 5), (0, 1, 4, 5, 6)),
    11: ((0, 1, 2, 3, 5), (0, 1, 4, 7, 8)),
    10: ((0, 1, 2, 4), (0, 1, 4, 5)),
    9: ((0, 1, 2, 4, 5),),
    8: ((0, 1, 2, 4),),
    7: ((0, 1, 3, 4),),
    6: ((0, 1, 3),),
    5: ((0, 2),),
    4: ((0, 1, 2, 3),),
    3: ((0, 1, 2),),
    2: ((0, 1),),
    1: ((0,),),
}


def _hashes(text: Column) -> Column:
    """Hashes of the lower-cased words."""
    return F.transform(words_of(F.lower(text)), lambda word: F.xxhash64(word))


def _overlap(words: Column) -> Column:
    """Words of an overlap of an item."""
    return F.least(F.size(words), F.lit(OVERLAP))


def _keys(lengths: list[int], words: Column, start: Column) -> Column:
    """The keys of the seeds at a place, null beyond the end; each mask has keys of its own."""
    return F.array(*[
        F.when(
            start + mask[-1] < F.size(words),
            F.xxhash64(F.lit(f"{length}.{i}"), *[F.get(words, start + k) for k in mask]),
        )
        for length in lengths for i, mask in enumerate(MASKS[length])
    ])


def _first_two(words: Column, start: Column) -> Column:
    return F.xxhash64(words[start], F.get(words, start + 1))


def _places(rows: DataFrame) -> DataFrame:
    """rows with start, each place of their words."""
    # Not a filter, which the optimiser would move below the words and so compute them twice.
    last = F.size("words") - 1
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return rows.withColumn("start", F.explode(starts))


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, hits and first_word for each document that holds a passage of an item.

    A passage counts if OVERLAP words in a row of the item (all words of a shorter item) stand in
    the document with at least EQUAL_PERCENT of them equal, case aside, and the others replaced;
    so items of fewer than five words count unchanged only.  hits is the number of equal seeds within
    such passages, first_word the place of the first.  Null or empty texts hold nothing and are
    held by nothing.  Rows with one doc_id count as one document, a null one too, and rows with
    one item_id as one item; a repeated row adds to hits.  Empty tables give no rows; other
    columns are left out.

    The masks of a passage's length miss none (see MASKS).  Seeds of the benchmark carry their
    item and place only and are broadcast behind a check of their size (see `small`), so that the
    places of the documents, rows that exist in generated code only, are not shuffled; a first
    look at two words spares most places the other hashes.  Hits, which are few, take the words
    around them along, and are then compared with the words of their item and counted before the
    shuffle.  Beyond that size Spark joins the places, without any words, by a shuffle, and the
    words around the hits are then taken from the documents that have some.
    """
    items = stage(
        benchmark.select(benchmark["item_id"].alias("item_id"), _hashes(benchmark["text"]).alias("words"))
        .where(F.size("words") > 0).withColumn("item", F.monotonically_increasing_id()),
        "items",
    )
    # At most OVERLAP rows.
    lengths = sorted(row.n for row in items.select(_overlap(F.col("words")).alias("n")).distinct().collect())
    if not lengths:
        kind = {name: df.schema[name].dataType.simpleString() for df, name in ((docs, "doc_id"), (benchmark, "item_id"))}
        return docs.sparkSession.createDataFrame(
            [], f"doc_id {kind['doc_id']}, item_id {kind['item_id']}, hits long, first_word long"
        )
    words, start = F.col("words"), F.col("start")
    # Each item has seeds by the masks of its own length.
    of_items = stage(
        reduce(DataFrame.unionByName, [
            _places(items.where(_overlap(words) == n)).select(
                "item", start.alias("item_start"), F.explode(_keys([n], words, start)).alias("key"),
                F.lit(n).alias("n"), _first_two(words, start).alias("pair"),
            )
            for n in lengths
        ]).where("key IS NOT NULL"),
        "seeds",
    )
    broadcast = fits_broadcast(of_items)
    masks = [mask for n in lengths for mask in MASKS[n]]
    texts = docs.select(
        docs["doc_id"].alias("doc_id"), F.xxhash64(docs["text"]).alias("tag"), _hashes(docs["text"]).alias("words")
    )
    places = _places(texts)
    if all(mask[:2] == (0, 1) for mask in masks):
        pairs = small(of_items.select("pair").distinct())
        places = places.join(pairs, _first_two(words, start) == pairs["pair"], "left_semi")
    keyed = F.posexplode(_keys(lengths, words, start)).alias("mask", "key")
    # Words before a seed that an overlap can have, and as many from its first one on.
    begin = F.greatest(start - (OVERLAP - 1), F.lit(0))
    around = F.slice(words, begin + 1, F.lit(2 * OVERLAP - 1)).alias("its_words")
    of_items = of_items.drop("pair")
    if broadcast:
        hits = places.select("doc_id", "words", "start", keyed).join(F.broadcast(of_items), "key").drop("key")
        hits = hits.select("doc_id", "item", "item_start", "n", "start", "mask", begin.alias("begin"), around)
    else:
        hits = places.select("doc_id", "tag", "start", keyed).where("key IS NOT NULL").join(of_items, "key").drop("key")
        hits = stage(hits, "places")
        # A text that stands in several rows counts for each, so the places are needed once.
        held = hits.distinct().withColumnRenamed("doc_id", "id").withColumnRenamed("tag", "its_tag")
        hits = texts.join(held, texts["doc_id"].eqNullSafe(F.col("id")) & (texts["tag"] == F.col("its_tag")))
        hits = hits.select("doc_id", "item", "item_start", "n", "start", "mask", begin.alias("begin"), around)
    span = F.element_at(F.array(*[F.lit(mask[-1] + 1) for mask in masks]), F.col("mask") + 1)
    compared = stage(hits, "hits").withColumn("span", span).join(small(items), "item")
    # Where the item would begin in the document, counted from the first of its words at hand.
    shift = start - F.col("item_start") - F.col("begin")
    last = F.size("words") - F.col("n")

    def enough(first: Column) -> Column:
        """Whether the overlap that begins at a word of the item is equal enough."""
        equal = F.aggregate(
            F.sequence(F.lit(0), F.col("n") - 1), F.lit(0),
            lambda so_far, k: so_far + F.coalesce(
                (F.get(words, first + k) == F.get(F.col("its_words"), first + k + shift)).cast("int"), F.lit(0)
            ),
        )
        return 100 * equal >= EQUAL_PERCENT * F.col("n")

    lowest = F.greatest(F.lit(0), F.col("item_start") + F.col("span") - F.col("n"))
    highest = F.least(F.col("item_start"), last)
    return (
        compared.where(lowest <= highest)
        .where(F.exists(F.sequence(lowest, highest), enough))
        .groupBy("doc_id", "item_id").agg(F.count("*").alias("hits"), F.min("start").cast("long").alias("first_word"))
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs without those that hold a passage of benchmark, with all their columns.

    All rows of a doc_id go if one of them leaks, a null doc_id too.  Their ids are broadcast
    behind a check of their size, so that texts are not shuffled.
    """
    leaks = small(find_leaks(docs, benchmark).select(F.col("doc_id").alias("leaked")).distinct())
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks["leaked"]), "left_anti")


def oracle_sql() -> str:
    """The rows of `find_leaks` in plain SQL, by the words themselves."""
    words = "regexp_extract_all(lower(text), '[^\\x20\\x09-\\x0D]+')"

    def seeds(name: str, condition: str) -> str:
        return " UNION ALL ".join(
            f"SELECT id, s, {mask[-1] + 1} AS span, "
            + " || ' ' || ".join([f"'{n}.{i}'", *[f"w[s + {k + 1}]" for k in mask]])
            + f" AS key FROM (SELECT id, w, unnest(range(len(w) - {mask[-1]})) AS s FROM {name}"
            f" WHERE len(w) > {mask[-1]} AND {condition.format(n)})"
            for n, own in MASKS.items() for i, mask in enumerate(own)
        )

    return (
        f"WITH d AS (SELECT doc_id AS id, {words} AS w FROM documents WHERE text IS NOT NULL),"
        f" b0 AS (SELECT item_id AS id, {words} AS w FROM benchmark WHERE text IS NOT NULL),"
        f" b AS (SELECT *, least({OVERLAP}, len(w)) AS n FROM b0),"
        f" ds AS ({seeds('d', '{} IN (SELECT n FROM b)')}), bs AS ({seeds('b', 'n = {}')}),"
        " hit AS (SELECT ds.id AS doc_id, bs.id AS item_id, ds.s AS s, bs.s AS bs, bs.span AS span FROM ds JOIN bs USING (key)),"
        " near AS (SELECT hit.*, b.w AS bw, d.w AS dw, n FROM hit JOIN b ON b.id = item_id JOIN d ON d.id = doc_id),"
        " run AS (SELECT *, unnest(range(greatest(0, bs + span - n), least(bs, len(bw) - n) + 1)) AS f FROM near),"
        " good AS (SELECT DISTINCT doc_id, item_id, s, bs, span FROM run"
        " WHERE 100 * len([k FOR k IN range(n) IF s + f + k >= bs AND bw[f + k + 1] = dw[s + f + k - bs + 1]])"
        f" >= {EQUAL_PERCENT} * n)"
        " SELECT doc_id, item_id, count(*) AS hits, min(s) AS first_word FROM hit"
        " JOIN good USING (doc_id, item_id, s, bs, span) GROUP BY doc_id, item_id"
    )
