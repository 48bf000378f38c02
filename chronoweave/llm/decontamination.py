"""Benchmark passages in documents, also with other numbers, names and units.

DataFrame and SQL functions only.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Words taken as units of measure.
UNITS = ("km", "kg", "cm", "mm", "ml", "kmh", "mph", "hour", "hours", "minute", "minutes", "second", "seconds", "day",
         "days", "week", "weeks", "month", "months", "year", "years", "meter", "meters", "metre", "metres", "mile",
         "miles", "foot", "feet", "inch", "inches", "pound", "pounds", "gram", "grams", "kilogram", "kilograms", "liter",
         "liters", "litre", "litres", "dollar", "dollars", "euro", "euros", "cent", "cents", "percent")
#: Characters cut from the edges of a word.
PUNCTUATION = ".,;:!?\"'()[]{}<>|*#%&$@+-_=~^`/\\"

_QUOTED = PUNCTUATION.replace("\\", "\\\\").replace("'", "\\'")
_UNIT_SQL = ", ".join(f"'{u}'" for u in UNITS)


def words_sql(text: str) -> str:
    """The words of a text, without punctuation at their edges and without words that are nothing else."""
    return (f"filter(transform(split(coalesce({text}, ''), '\\\\s+'), w -> btrim(w, '{_QUOTED}')), "
            "w -> w <> '')")


#: A word's place in a template: typed placeholder, or the word in lower case.
TYPED = ("CASE WHEN left({w}, 1) BETWEEN '0' AND '9' THEN '<num>' "
         f"WHEN lower({{w}}) IN ({_UNIT_SQL}) THEN '<unit>' "
         "WHEN lower(left({w}, 1)) <> left({w}, 1) THEN '<name>' ELSE lower({w}) END")


def _windows(typed: str, lower: str, n: int) -> str:
    """Array of (position, hash of the template, hash of the lower-case words) of all ``n``-word windows."""
    return (f"CASE WHEN size({typed}) >= {n} THEN transform(sequence(0, size({typed}) - {n}), i -> struct(i AS pos, "
            f"xxhash64(slice({typed}, i + 1, {n})) AS ht, xxhash64(slice({lower}, i + 1, {n})) AS hl)) END")


def item_windows(items: DataFrame, *, window: int, literals: int, item: str, text: str) -> DataFrame:
    """item, n (words of the window), ipos, iwords, ityped, templated, h: all windows of every item,
    by each of their keys: the hash of the lower-case words and, where ``templated`` (at least
    ``literals`` words that are not placeholders), that of the template. An item with fewer than
    ``window`` words is one window."""
    base = (items.select(F.col(item).alias("item_id"), F.expr(words_sql(f"`{text}`")).alias("w"))
            .withColumn("t", F.expr(f"transform(w, x -> {TYPED.format(w='x')})"))
            .withColumn("n", F.least(F.lit(window), F.size("w"))).where("n > 0"))
    one = base.select("item_id", "n", "w", "t", F.explode(F.expr("sequence(0, size(t) - n)")).alias("ipos"))
    one = one.select("item_id", "n", "ipos", F.expr("slice(w, ipos + 1, n)").alias("iwords"),
                     F.expr("slice(t, ipos + 1, n)").alias("ityped"))
    enough = F.expr(f"size(filter(ityped, x -> NOT startswith(x, '<'))) >= least({literals}, n)")
    literal = F.xxhash64(F.transform("iwords", F.lower))
    return (one.withColumn("templated", enough)
            .withColumn("h", F.explode(F.when(enough, F.array_distinct(F.array(literal, F.xxhash64("ityped"))))
                                       .otherwise(F.array(literal)))))


def contaminated(docs: DataFrame, items: DataFrame, *, window: int = 8, literals: int = 4, least_share: float = 0.5,
                 run_words: int = 13, consistent: float = 0.8, key: str = "doc_id", text: str = "text",
                 item: str = "item_id", item_text: str = "text") -> DataFrame:
    """Pairs of a document and a benchmark item whose passage it holds.

    Words become templates: numbers, names (words that begin with a capital) and units are typed
    placeholders, other words their lower case. Template windows of items and documents are
    hash-joined. Matches on one diagonal (document position minus item position) are one
    alignment; its slots must be consistent, that is each item value stands for one document
    value (``consistent``: least share of distinct values to distinct pairs), which a
    re-parameterised question meets and chance matches don't. Only windows with ``literals`` words
    that are not placeholders have a template. A pair counts if consistent
    alignments match ``least_share`` of the item's templates, or ``run_words`` words of it on one
    diagonal.

    In the same join all windows also meet by their words in lower case, whatever their letter case
    and however few of them are literals; such a match needs no slots. A pair that doesn't count
    by templates alone counts if matches of either kind reach ``least_share`` of all windows of
    the item, or ``run_words`` words on one diagonal.

    Returns key, item_id, n_windows (distinct matched windows of the item), item_windows,
    coverage, consistency (of the worst alignment that counts), exact (all slots equal; of windows
    matched by words alone, but for letter case), first, last (word positions in the document).
    The numbers are those of the templates if they suffice, otherwise those of matches of either
    kind over all windows. Null text: no words. Null keys match as one document;
    rows that share a key are one document. Repeated items are items of their own if their ids
    differ; equal ids: one item, its windows counted once. No items or no documents: no rows.
    Other columns are ignored.
    """
    grams = item_windows(items, window=window, literals=literals, item=item, text=item_text)
    grams = grams.dropDuplicates(["item_id", "n", "ipos", "h"])
    sizes = sorted(r["n"] for r in grams.select("n").distinct().collect())  # at most `window` numbers
    templates = docs.select(F.col(key).alias("k"), F.expr(words_sql(f"`{text}`")).alias("w")).select(
        "k", F.expr(f"transform(w, x -> {TYPED.format(w='x')})").alias("t"), F.transform("w", F.lower).alias("l"))
    # a window without placeholders has one key: its template is its words
    keys = F.expr("CASE WHEN x.ht = x.hl THEN array(x.hl) ELSE array(x.ht, x.hl) END")
    found = None
    for n in sizes:
        own = (templates.select("k", F.explode(F.expr(_windows("t", "l", n))).alias("x"))
               .select("k", "x.pos", F.explode(keys).alias("h")))
        part = own.join(grams.where(F.col("n") == n), "h").select(
            "k", "item_id", "n", "pos", "ipos", "iwords", "ityped", "templated")
        found = part if found is None else found.union(part)
    total = grams.groupBy("item_id").agg(
        F.size(F.collect_set(F.when(F.col("templated"), F.struct("n", "ipos")))).alias("templates"),
        F.size(F.collect_set(F.struct("n", "ipos"))).alias("all_windows"))
    if found is None:
        found = grams.limit(0).join(templates.limit(0)).select(
            "k", "item_id", "n", F.col("ipos").alias("pos"), "ipos", "iwords", "ityped", "templated")
    # matched places, by document: then one look at the words that stand there
    by_doc = found.groupBy(F.col("k").alias("mk")).agg(F.collect_set(F.struct(
        "item_id", "n", "pos", "ipos", "iwords", "ityped", "templated")).alias("m"))
    texts = docs.select(F.col(key).alias("k"), F.col(text).alias("x"))
    words = F.expr(words_sql("x")).alias("w")
    at = (texts.join(by_doc, F.col("k").eqNullSafe(F.col("mk"))).select("k", words, "m")
          .select("k", "w", F.explode("m").alias("m")).select("k", "w", "m.*")
          .withColumn("dwords", F.expr("slice(w, pos + 1, n)"))
          # rows that share a key: only the row that holds the window
          .withColumn("by_type", F.expr(f"templated AND transform(dwords, x -> {TYPED.format(w='x')}) = ityped"))
          .withColumn("by_word", F.expr("transform(dwords, x -> lower(x)) = transform(iwords, x -> lower(x))"))
          .where("by_type OR by_word"))
    slots = F.expr("""CASE WHEN by_type THEN filter(transform(sequence(1, n), i -> struct(
        element_at(ityped, i) AS kind, element_at(iwords, i) AS item, element_at(dwords, i) AS doc)),
        s -> startswith(s.kind, '<')) END""")
    diag = (at.select("k", "item_id", "n", "ipos", "pos", "by_type", "by_word", slots.alias("slots"))
            .groupBy("k", "item_id", (F.col("pos") - F.col("ipos")).alias("diag"))
            .agg(F.array_distinct(F.flatten(F.collect_set("slots"))).alias("pairs"), F.max("n").alias("n"),
                 *(x for kind in ("by_type", "by_word") for x in (
                     F.collect_set(F.when(F.col(kind), F.struct("n", "ipos"))).alias(kind),
                     F.min(F.when(F.col(kind), F.col("pos"))).alias(f"{kind}_first"),
                     F.max(F.when(F.col(kind), F.col("pos") + F.col("n") - 1)).alias(f"{kind}_last")))))
    values = F.size(F.array_distinct(F.transform("pairs", lambda p: F.struct(p["kind"], p["item"]))))
    diag = (diag.withColumn("consistency", F.when(F.size("pairs") > 0, values / F.size("pairs")).otherwise(F.lit(1.0)))
            .withColumn("exact", F.forall("pairs", lambda p: p["item"] == p["doc"]))
            .withColumn("fits", (F.size("by_type") > 0) & (F.col("consistency") >= consistent))
            .withColumn("either", F.when(F.col("fits"), F.array_union("by_type", "by_word")).otherwise(F.col("by_word")))
            .where("fits OR size(by_word) > 0"))
    fits = lambda c: F.when(F.col("fits"), c)
    count = lambda c: F.size(F.array_distinct(F.flatten(F.collect_list(c))))
    pairs = diag.groupBy("k", "item_id").agg(
        F.min(fits(F.col("consistency"))).alias("consistency"), F.min(fits(F.col("exact"))).alias("exact"),
        count(fits(F.col("by_type"))).alias("t_windows"), F.max(fits(F.size("by_type") + F.col("n") - 1)).alias("t_run"),
        F.min(fits(F.col("by_type_first"))).alias("t_first"), F.max(fits(F.col("by_type_last"))).alias("t_last"),
        count("either").alias("e_windows"), F.max(F.size("either") + F.col("n") - 1).alias("e_run"),
        F.min("by_word_first").alias("w_first"), F.max("by_word_last").alias("w_last"))
    by_type = (F.col("t_windows") > 0) & (
        (F.col("t_windows") / F.col("templates") >= least_share) | (F.col("t_run") >= run_words))
    either = (F.col("e_windows") / F.col("all_windows") >= least_share) | (F.col("e_run") >= run_words)
    pick = lambda t, e: F.when(F.col("typed"), t).otherwise(e)
    return (pairs.join(total, "item_id").withColumn("typed", F.coalesce(by_type, F.lit(False))).where(F.col("typed") | either)
            .select("k", "item_id", F.coalesce("consistency", F.lit(1.0)).alias("consistency"),
                    F.coalesce("exact", F.lit(True)).alias("exact"),
                    pick(F.col("t_windows"), F.col("e_windows")).cast("int").alias("n_windows"),
                    pick(F.col("templates"), F.col("all_windows")).cast("int").alias("item_windows"),
                    pick(F.col("t_first"), F.least("t_first", "w_first")).alias("first"),
                    pick(F.col("t_last"), F.greatest("t_last", "w_last")).alias("last"))
            .select(F.col("k").alias(key), "item_id", "n_windows", "item_windows",
                    (F.col("n_windows") / F.col("item_windows")).alias("coverage"), "consistency", "exact", "first", "last"))


_DUCK_PUNCT = PUNCTUATION.replace("'", "''")


def _duck_words(text: str) -> str:
    return (f"list_filter(list_transform(string_split_regex(coalesce({text}, ''), '[ \\t\\n\\x0B\\f\\r]+'), "
            f"lambda w: trim(w, '{_DUCK_PUNCT}')), lambda w: w <> '')")


def _duck_typed(w: str) -> str:
    return f"list_transform({w}, lambda x: {TYPED.format(w='x')}) AS t, list_transform({w}, lambda x: lower(x)) AS l"


#: The whole rule in DuckDB SQL: templates, and windows that meet by their words in lower case.
ORACLE = f"""
WITH iw AS (SELECT DISTINCT item_id, {_duck_words('text')} AS w FROM benchmark),
it AS (SELECT *, least(8, len(w)) AS n, {_duck_typed('w')} FROM iw WHERE len(w) > 0),
ig AS (SELECT item_id, n, p AS ipos, w[p + 1:p + n] AS iwords, t[p + 1:p + n] AS ityped, l[p + 1:p + n] AS ilower
       FROM (SELECT *, unnest(range(len(w) - n + 1)) AS p FROM it)),
ik AS (SELECT *, len(list_filter(ityped, lambda x: NOT starts_with(x, '<'))) >= least(4, n) AS templated FROM ig),
tot AS (SELECT item_id, count(*) FILTER (WHERE templated) AS templates, count(*) AS all_windows FROM ik GROUP BY item_id),
dw AS (SELECT doc_id, {_duck_words('text')} AS w FROM documents),
dt AS (SELECT *, {_duck_typed('w')} FROM dw),
dg AS (SELECT doc_id, n, p AS pos, w[p + 1:p + n] AS dwords, t[p + 1:p + n] AS dtyped, l[p + 1:p + n] AS dlower
       FROM (SELECT dt.*, n, unnest(range(len(w) - n + 1)) AS p FROM dt, (SELECT DISTINCT n FROM it) WHERE len(w) >= n)),
m AS (SELECT doc_id, item_id, n, pos, ipos, pos - ipos AS diag, iwords, dwords, ityped,
             templated AND dtyped = ityped AS by_type, dlower = ilower AS by_word
      FROM (SELECT * FROM dg JOIN ik USING (n) WHERE templated AND dtyped = ityped
            UNION SELECT * FROM dg JOIN ik USING (n) WHERE dlower = ilower)),
s AS (SELECT doc_id, item_id, diag, ityped[i] AS kind, iwords[i] AS a, dwords[i] AS b
      FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM m WHERE by_type) WHERE starts_with(ityped[i], '<')),
c AS (SELECT doc_id, item_id, diag, count(DISTINCT (kind, a)) / count(DISTINCT (kind, a, b)) AS consistency, bool_and(a = b) AS exact
      FROM s GROUP BY ALL),
f AS (SELECT m.*, coalesce(consistency, 1.0) AS consistency, coalesce(exact, true) AS exact,
             coalesce(consistency, 1.0) >= 0.8 AND by_type AS fits
      FROM m LEFT JOIN c USING (doc_id, item_id, diag)),
d AS (SELECT doc_id, item_id, diag, count(DISTINCT ipos) FILTER (WHERE fits) + max(n) - 1 AS t_run, bool_or(fits) AS fits,
             count(DISTINCT ipos) FILTER (WHERE fits OR by_word) + max(n) - 1 AS e_run
      FROM f GROUP BY ALL HAVING bool_or(fits OR by_word)),
r AS (SELECT doc_id, item_id, max(t_run) FILTER (WHERE fits) AS t_run, max(e_run) AS e_run FROM d GROUP BY ALL),
p AS (SELECT doc_id, item_id, count(DISTINCT ipos) FILTER (WHERE fits) AS t_windows,
             count(DISTINCT ipos) FILTER (WHERE fits OR by_word) AS e_windows,
             min(consistency) FILTER (WHERE fits) AS consistency, bool_and(exact) FILTER (WHERE fits) AS exact,
             min(pos) FILTER (WHERE fits) AS t_first, max(pos + n - 1) FILTER (WHERE fits) AS t_last,
             min(pos) FILTER (WHERE by_word) AS w_first, max(pos + n - 1) FILTER (WHERE by_word) AS w_last
      FROM f GROUP BY ALL),
q AS (SELECT *, t_windows > 0 AND (t_windows / templates >= 0.5 OR t_run >= 13) AS typed
      FROM p JOIN r USING (doc_id, item_id) JOIN tot USING (item_id))
SELECT doc_id, item_id, CAST(CASE WHEN typed THEN t_windows ELSE e_windows END AS INTEGER) AS n_windows,
       CAST(CASE WHEN typed THEN templates ELSE all_windows END AS INTEGER) AS item_windows,
       CASE WHEN typed THEN t_windows / templates ELSE e_windows / all_windows END AS coverage,
       coalesce(consistency, 1.0) AS consistency, coalesce(exact, true) AS exact,
       CAST(CASE WHEN typed THEN t_first ELSE least(t_first, w_first) END AS INTEGER) AS first,
       CAST(CASE WHEN typed THEN t_last ELSE greatest(t_last, w_last) END AS INTEGER) AS last
FROM q WHERE typed OR e_windows / all_windows >= 0.5 OR e_run >= 13
"""
