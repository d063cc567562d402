"""Quality rules with thresholds learned from the corpus, per language and source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import let, stage, words_of

#: Words of a window whose repetition within a text counts.
WINDOW = 8
#: A text fails outright with fewer words, or more per cent of its words in repeated windows.
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
#: Weight, in documents, that the limits of a language have in those of each of its sources.
PRIOR = 200
#: Distance of a fence from its quartile, in interquartile ranges.
REACH = 3
#: The sketch names a value up to this part of it too low, so no range is taken for less.
ERROR = 64
#: The statistics, as whole numbers.
STATISTICS = {
    "word_length": "1000 * word_chars div n_words",
    "symbols": "10000 * n_symbols div word_chars",
    "dup_lines": "1000 * n_dup_lines div n_lines",
    "repeats": "1000 * n_repeat_words div n_words",
}
#: The statistics that may also be too low.
TWO_SIDED = ("word_length",)


def _in_repeated_windows(words: Column) -> Column:
    """How many words lie in a window of eight that occurs twice or more in the text."""

    def covered(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        starts = let(placed, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, i: (x.h == F.get(s, i - 1).h) | (x.h == F.get(s, i + 1).h)),
            lambda x: x["at"],
        )))
        return F.aggregate(
            starts,
            F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
            lambda sofar, at: F.struct(
                at.alias("last"), (sofar.n + F.least(F.lit(WINDOW), at - sofar["last"])).alias("n")
            ),
            lambda sofar: sofar.n,
        )

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1)),
            lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)),
        )

    def count(hashes: Column) -> Column:
        return F.when(F.size(hashes) < WINDOW, 0).otherwise(let(
            windows(hashes),
            lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(covered(w)),
        ))

    return let(F.transform(words, lambda word: F.xxhash64(word)), count).cast("long")


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of each whole text; all counts of a null text are 0."""
    split = docs.select(
        docs["doc_id"].alias("doc_id"),
        docs["lang"].alias("lang"),
        docs["source"].alias("source"),
        F.coalesce(docs["text"], F.lit("")).alias("text"),
    ).select(
        "doc_id", "lang", "source", "text",
        words_of(F.col("text")).alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    counted = split.select(
        "doc_id", "lang", "source",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _in_repeated_windows(F.col("words")).alias("n_repeat_words"),
    )
    return counted.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )


def sketches(stats: DataFrame) -> DataFrame:
    """lang, source, statistic, bucket, n: a quantile sketch of each statistic of a group.

    Zeros, which most documents have in most statistics and which always pass, are left out: the
    quartiles are those of the documents that have some.  A bucket holds the values with the same seven leading bits and is named by the least of
    them, so a quantile is at most 1/64 too low.  Two sketches merge by adding up n, whatever
    the order, and give the same result in every run.
    """
    values = F.array(*[
        F.struct(F.lit(name).alias("statistic"), F.expr(value).alias("value"))
        for name, value in STATISTICS.items()
    ])
    shift = F.expr("int(greatest(0, length(bin(value)) - 7))")
    return (
        stats.where(~F.col("base_failed"))
        .select("lang", "source", F.explode(values).alias("v"))
        .select("lang", "source", "v.*").where("value > 0")
        .withColumn("bucket", F.call_function("shiftleft", F.call_function("shiftright", "value", shift), shift))
        .groupBy("lang", "source", "statistic", "bucket")
        .agg(F.count("*").alias("n"))
    )


def fences(sketch: DataFrame, *keys: str) -> DataFrame:
    """keys and per statistic n (documents that have some of it), the lowest and highest value that passes."""
    group = Window.partitionBy(*keys, "statistic")
    ranked = sketch.select(
        *keys, "statistic", "bucket",
        F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        F.sum("n").over(group).alias("total"),
    )
    quartiles = ranked.groupBy(*keys, "statistic").agg(
        F.max("total").alias("total"),
        F.min(F.when(4 * F.col("upto") >= F.col("total"), F.col("bucket"))).alias("q1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("total"), F.col("bucket"))).alias("q3"),
    )
    spread = REACH * F.greatest(F.col("q3") - F.col("q1"), F.expr(f"1 + q3 div {ERROR}"))
    columns = []
    for name in STATISTICS:
        of = F.col("statistic") == name
        columns.append(F.max(F.when(of, F.col("total"))).alias(f"{name}_n"))
        columns.append(F.max(F.when(of, F.col("q3") + spread)).alias(f"{name}_high"))
        columns.append(F.max(F.when(of, F.col("q1") - spread)).alias(f"{name}_low"))
    return quartiles.groupBy(*keys).agg(*columns)


def apply_quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed and kept of each row of docs.

    A document that does not fail outright is kept if every statistic lies within the fences of
    its language and source, q1 - 3 IQR (for the length of words only) and q3 + 3 IQR, with
    quartiles of the documents that have some of it; the range is never taken for less than the
    sketch can tell apart.  The limits of a source are a mean of its own, with its number of such
    documents as their weight, and those of its language, with PRIOR: they move to its own as it
    grows.  Without a document that has some of it, a statistic has no limit.  A null language
    or source is a group like any other.  A text that is null, empty or only white space fails;
    repeated rows are judged each; an empty table gives no rows.  Other columns of docs are left out.

    The counts are staged, so the texts are read once.  A hot source leaves every task as at
    most some hundred buckets, and Spark chooses the join with the fences by their actual size.
    """
    stats = stage(statistics(docs), "statistics")
    by_source = sketches(stats)
    by_lang = by_source.groupBy("lang", "statistic", "bucket").agg(F.sum("n").alias("n"))
    own, wider = fences(by_source, "lang", "source"), fences(by_lang, "lang")
    blended = [
        F.expr(f"coalesce((o.{name}_n * o.{name}_{side} + {PRIOR} * w.{name}_{side}) div (o.{name}_n + {PRIOR}), w.{name}_{side})")
        .alias(f"{name}_{side}")
        for name in STATISTICS for side in ("low", "high")
    ]
    thresholds = own.alias("o").join(wider.alias("w"), F.col("o.lang").eqNullSafe(F.col("w.lang"))).select(
        F.col("o.lang").alias("lang"), F.col("o.source").alias("source"), *blended
    )
    passes = F.lit(True)
    for name, value in STATISTICS.items():
        passes &= F.expr(f"{value} = 0 OR coalesce({value} <= {name}_high, true)")
        if name in TWO_SIDED:
            passes &= F.expr(f"coalesce({value} >= {name}_low, true)")
    return (
        stats.alias("s")
        .join(
            thresholds.alias("t"),
            F.col("s.lang").eqNullSafe(F.col("t.lang")) & F.col("s.source").eqNullSafe(F.col("t.source")),
            "left",
        )
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
            F.when(F.col("base_failed"), False).otherwise(passes).alias("kept"),
        )
    )


def oracle_sql() -> str:
    """The same rows in plain SQL."""
    space = r"[^\x20\x09-\x0D]"
    ctes = [
        "t AS (SELECT row_number() OVER () AS id, doc_id, lang, source, coalesce(text, '') AS text FROM documents)",
        f"w AS (SELECT id, regexp_extract_all(text, '{space}+') AS w FROM t)",
        f"win AS (SELECT id, s, array_to_string(w[s:s + {WINDOW - 1}], ' ') AS g FROM"
        f" (SELECT id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS s FROM w WHERE len(w) >= {WINDOW}) x)",
        "twice AS (SELECT id, g FROM win GROUP BY id, g HAVING count(*) > 1)",
        "cover AS (SELECT id, count(DISTINCT s + k) AS n FROM win JOIN twice USING (id, g),"
        f" (SELECT unnest(range({WINDOW})) AS k) ks GROUP BY id)",
        "l AS (SELECT id, unnest(string_split(text, chr(10))) AS line FROM t)",
        f"ln AS (SELECT id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM l"
        f" WHERE regexp_matches(line, '{space}') GROUP BY id)",
        "st AS (SELECT t.id AS id, doc_id, lang, source, len(w) AS n_words,"
        " length(array_to_string(w, '')) AS word_chars,"
        " length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,"
        " coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,"
        " coalesce(cover.n, 0) AS n_repeat_words FROM t JOIN w ON w.id = t.id"
        " LEFT JOIN ln ON ln.id = t.id LEFT JOIN cover ON cover.id = t.id)",
        f"b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"
        " AS base_failed FROM st)",
    ]
    values = {name: value.replace(" div ", " // ") for name, value in STATISTICS.items()}
    ctes.append("v AS (" + " UNION ALL ".join(
        f"SELECT lang, source, '{name}' AS statistic, ({value})::BIGINT AS value FROM b WHERE NOT base_failed"
        for name, value in values.items()
    ) + ")")
    shift = "greatest(0, length(bin(value)) - 7)::INTEGER"
    ctes.append(f"sk AS (SELECT lang, source, statistic, ((value >> {shift}) << {shift}) AS bucket, count(*) AS n"
                " FROM v WHERE value > 0 GROUP BY ALL)")
    for name, keys in (("own", "lang, source"), ("wider", "lang")):
        ctes.append(
            f"{name}r AS (SELECT {keys}, statistic, bucket, sum(n) OVER (PARTITION BY {keys}, statistic ORDER BY bucket)"
            f" AS upto, sum(n) OVER (PARTITION BY {keys}, statistic) AS total FROM"
            f" (SELECT {keys}, statistic, bucket, sum(n) AS n FROM sk GROUP BY ALL) x)"
        )
        ctes.append(
            f"{name}q AS (SELECT {keys}, statistic, max(total) AS total,"
            " min(CASE WHEN 4 * upto >= total THEN bucket END) AS q1,"
            f" min(CASE WHEN 4 * upto >= 3 * total THEN bucket END) AS q3 FROM {name}r GROUP BY {keys}, statistic)"
        )
        limits, spread = [], f"{REACH} * greatest(q3 - q1, 1 + q3 // {ERROR})"
        for statistic in STATISTICS:
            of = f"CASE WHEN statistic = '{statistic}' THEN"
            limits.append(f"max({of} total END) AS {statistic}_n")
            limits.append(f"max({of} q3 + {spread} END) AS {statistic}_high")
            limits.append(f"max({of} q1 - {spread} END) AS {statistic}_low")
        ctes.append(f"{name} AS (SELECT {keys}, {', '.join(limits)} FROM {name}q GROUP BY {keys})")

    def limit(name: str, side: str) -> str:
        # As `div` does, towards zero.
        blended = f"(own.{name}_n * own.{name}_{side} + {PRIOR} * wider.{name}_{side})::DOUBLE / (own.{name}_n + {PRIOR})"
        return f"coalesce(trunc({blended}), wider.{name}_{side})"

    passes = [f"({value} = 0 OR coalesce({value} <= {limit(name, 'high')}, true))" for name, value in values.items()]
    passes += [f"coalesce({values[name]} >= {limit(name, 'low')}, true)" for name in TWO_SIDED]
    return (
        "WITH " + ", ".join(ctes) + " SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,"
        f" base_failed, CASE WHEN base_failed THEN false ELSE {' AND '.join(passes)} END AS kept FROM b"
        " LEFT JOIN own ON own.lang IS NOT DISTINCT FROM b.lang AND own.source IS NOT DISTINCT FROM b.source"
        " LEFT JOIN wider ON wider.lang IS NOT DISTINCT FROM b.lang"
    )
