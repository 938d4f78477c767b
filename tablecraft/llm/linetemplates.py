"""Recurring lines by a log-template tree, as DataFrame operations only.

Lines are split at line feeds, tokens at white space. The tree has a fixed depth: its first
level is the number of tokens, the next ``DEPTH`` levels are the leading tokens, where a
token with a digit is the variable ``<*>``. A leaf is looked at further if its lines stand in
``LEAST_TEXTS`` different texts or more.

In such a leaf, a token that recurs at its place in as many texts is constant, any other is
``<*>``. The result is the line's template if ``SIMILARITY`` of its tokens are constant or
hold a digit; else the line stands for itself. Lines of templates that recur in
``LEAST_TEXTS`` texts are dropped from every document.

Texts, not rows, are counted, so copies of a document don't make its lines recur. Counting
works on distinct lines, so a line that stands in a third of all documents is one row. The
recurring leaves and lines are broadcast up to ``broadcast_rows`` of them, else shuffled.

Defined results: null and empty texts have one empty line. Lines without tokens are never
dropped. Rows that repeat give equal rows. An empty table gives an empty table. A very long text
is split in its task and travels once more with the places of its dropped lines; its lines travel
alone, each with two hashes, and work grows in proportion to its lines and tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.shared import settled

DEPTH = 3
LEAST_TEXTS = 10
SIMILARITY = 0.8
BROADCAST_ROWS = 200_000
_SPACE = r"[\x20\x09-\x0D]+"


def _tokens(line: Column) -> Column:
    return F.filter(F.split(line, _SPACE), lambda t: t != "")


def _masked(token: Column) -> Column:
    return F.when(token.rlike("[0-9]"), F.lit("<*>")).otherwise(token)


def _leaf(tokens: Column) -> Column:
    lead = F.transform(F.slice(tokens, 1, DEPTH), _masked)
    return F.concat_ws(" ", F.size(tokens).cast("string"), F.array_join(lead, " "))


def _lines(docs: DataFrame) -> DataFrame:
    """row, body, at, line: every line of every text.

    The hashes of a text are made before its lines, so that no line carries the text.
    """
    text = F.coalesce("text", F.lit(""))
    split = docs.select(F.xxhash64("doc_id", text).alias("row"), F.xxhash64(text).alias("body"), F.split(text, "\n").alias("_lines"))
    # No text is without lines; the outer form spares a filter that would split each text again.
    return split.select("row", "body", F.posexplode_outer("_lines").alias("at", "line"))


def _flags(size: Column, held: Column) -> Column:
    """Whether each place from 0 is among those held, without a search for every place."""
    free = F.array_except(F.sequence(F.lit(0), size - 1), held)

    def marked(places: Column, flag: bool) -> Column:
        return F.transform(places, lambda i: F.struct(i.alias("place"), F.lit(flag).alias("flag")))

    flags = F.transform(F.sort_array(F.concat(marked(held, True), marked(free, False))), lambda mark: mark["flag"])
    return F.when(held.isNull(), F.array_repeat(F.lit(False), size)).otherwise(flags)


def _bounded(frame: DataFrame, broadcast_rows: int) -> DataFrame:
    return F.broadcast(frame) if frame.count() <= broadcast_rows else frame


def recurring_lines(docs: DataFrame, least_texts: int = LEAST_TEXTS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """line, template, n_texts (of the template): the lines to drop."""
    leafed = _lines(docs).withColumn("tokens", _tokens(F.col("line"))).where(F.size("tokens") > 0).withColumn("leaf", _leaf(F.col("tokens")))
    leaves = leafed.select(F.xxhash64("leaf").alias("leaf_hash"), "body").distinct()
    leaves = leaves.groupBy("leaf_hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_texts).select("leaf_hash")
    leaves = _bounded(settled(leaves, "leaves"), broadcast_rows)
    inside = leafed.withColumn("leaf_hash", F.xxhash64("leaf")).join(leaves, "leaf_hash", "left_semi")
    lines = inside.select("leaf", "line", "body").distinct().groupBy("leaf", "line").agg(F.count(F.lit(1)).alias("n"))
    lines = settled(lines.withColumn("line_hash", F.xxhash64("leaf", "line")).withColumn("leaf", F.xxhash64("leaf")), "lines")

    # Tokens travel as hashes: one row for each token of a distinct line.
    hashes = F.transform(_tokens(F.col("line")), lambda t: F.xxhash64(t))
    spots = lines.select("leaf", "line_hash", "n", F.posexplode(hashes).alias("place", "token"))
    by_spot = ["leaf", "place", "token"]
    constant = spots.groupBy(*by_spot).agg(F.sum("n").alias("m")).where(F.col("m") >= least_texts).select(*by_spot)
    held = spots.join(constant, by_spot, "left_semi").groupBy("line_hash").agg(F.collect_set("place").alias("held"))
    made = lines.join(held, "line_hash", "left").withColumn("tokens", _tokens(F.col("line")))
    made = made.withColumn("fixed", _flags(F.size("tokens"), F.col("held")))
    constants = F.aggregate(
        F.zip_with("tokens", "fixed", lambda t, f: (f | t.rlike("[0-9]")).cast("int")), F.lit(0), lambda a, x: a + x
    )
    general = F.array_join(
        F.zip_with("tokens", "fixed", lambda t, f: F.when(f & ~t.rlike("[0-9]"), t).otherwise(F.lit("<*>"))), " "
    )
    alike = constants / F.size("tokens") >= SIMILARITY
    templates = made.select("leaf", "line", "n", F.when(alike, general).otherwise(F.col("line")).alias("template"))
    templates = settled(templates, "templates")
    totals = templates.groupBy("leaf", "template").agg(F.sum("n").alias("n_texts")).where(F.col("n_texts") >= least_texts)
    return templates.join(totals, ["leaf", "template"]).select("line", "template", "n_texts")


def drop_recurring_lines(docs: DataFrame, least_texts: int = LEAST_TEXTS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` with the text that is left, and n_lines and n_dropped beside its columns.

    A text keeps its lines in order, joined by line feeds; a null text becomes empty.
    """
    dropped = settled(recurring_lines(docs, least_texts, broadcast_rows).select(F.xxhash64("line").alias("line_hash")).distinct(), "dropped")
    places = _lines(docs).withColumn("line_hash", F.xxhash64("line")).join(_bounded(dropped, broadcast_rows), "line_hash", "left_semi")
    gone = places.select("row", "at").distinct().groupBy("row").agg(F.collect_set("at").alias("_gone"))
    gone = settled(gone.withColumnRenamed("row", "_row"), "gone")
    text = F.coalesce("text", F.lit(""))
    # What goes grows with the documents: never broadcast, and the same plan at every size.
    joined = docs.withColumn("_row", F.xxhash64("doc_id", text)).join(gone.hint("shuffle_hash"), "_row", "left")
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    split = joined.select(*others, "_gone", text.alias("_text"), F.split(text, "\n").alias("_lines"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    kept = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(F.col("_lines"), i)), "\n")
    )
    return split.select(
        *others,
        kept.alias("text"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def op9_line_templates(docs: DataFrame) -> DataFrame:
    cleaned = drop_recurring_lines(docs.select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.md5("text").alias("kept_md5"), F.length("text").cast("long").alias("n_chars"))


#: The same in SQL; the fixed numbers are those above.
OP9_SQL = r"""
    WITH lines AS (
        SELECT doc_id, coalesce(text, '') AS body, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
        FROM documents
    ), tokened AS (
        SELECT *, list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS tokens FROM lines
    ), leafed AS (
        SELECT *, concat(len(tokens), ' ', array_to_string(list_transform(tokens[1:3],
               lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END), ' ')) AS leaf
        FROM tokened WHERE len(tokens) > 0
    ), leaves AS (
        SELECT leaf FROM leafed GROUP BY leaf HAVING count(DISTINCT body) >= 10
    ), distinct_lines AS (
        SELECT leaf, line, any_value(tokens) AS tokens, count(DISTINCT body) AS n
        FROM leafed SEMI JOIN leaves USING (leaf) GROUP BY leaf, line
    ), spots AS (
        SELECT leaf, line, n, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS place FROM distinct_lines
    ), constant AS (
        SELECT leaf, place, token FROM spots GROUP BY ALL HAVING sum(n) >= 10
    ), own AS (
        SELECT s.leaf, s.line, s.n, s.place, regexp_matches(s.token, '[0-9]') AS digit, c.token IS NOT NULL AS fixed, s.token
        FROM spots s LEFT JOIN constant c ON s.leaf = c.leaf AND s.place = c.place AND s.token = c.token
    ), templates AS (
        SELECT leaf, line, n, CASE WHEN avg(CASE WHEN fixed OR digit THEN 1 ELSE 0 END) >= 0.8
               THEN string_agg(CASE WHEN fixed AND NOT digit THEN token ELSE '<*>' END, ' ' ORDER BY place)
               ELSE line END AS template
        FROM own GROUP BY leaf, line, n
    ), dropped AS (
        SELECT DISTINCT line FROM templates JOIN
               (SELECT leaf, template FROM templates GROUP BY leaf, template HAVING sum(n) >= 10) USING (leaf, template)
    ), marked AS (
        SELECT l.*, d.line IS NOT NULL AS gone FROM lines l LEFT JOIN dropped d ON l.line = d.line
    ), texts AS (
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text
        FROM marked GROUP BY doc_id
    )
    SELECT doc_id, n_lines, n_dropped, md5(text) AS kept_md5, length(text) AS n_chars FROM texts
"""
