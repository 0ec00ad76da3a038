"""Line dedup by winnowing over line hashes (operator 2), in column functions only.

A line goes if it lies in a run that also occurs earlier: in a document with a smaller id, or higher
up in the same one. A run is MIN_RUN lines or more (blank lines aside), or a single line of LONG_LINE
words or more.

1. Winnowing: in every window of MIN_RUN lines the line with the smallest hash is selected (the last
   of equals), a long line is a window of its own. What a window selects depends on its lines only, so
   equal runs select equal lines: the selected lines are guaranteed fingerprints of every run that counts.
2. Positions are joined on their fingerprint; those of fingerprints found once drop out.
3. Around the others matches are extended to both sides: the windows that hold the fingerprint are
   compared as wholes with the first place of the same window, line by line (two hashes of each). A run
   may match different earlier places with its front and its end, so each of its windows is compared
   with the first place of its own; the windows of a match of any length overlap and are all found.
4. Windows with an earlier place are later repeats; their union, run by run, is deleted.

Frequent lines meet no task as a group: counts and first places combine map-side, and adaptive
execution splits a frequent window where positions are joined.

Results in special cases: null text stays null; lines end at newlines only; blank lines stay where a line around them does
(a text without other lines is left as it is); rows equal in id and text are one document, listed
twice, and are treated alike; rows without an id come after all others; very long lines are one
hash, and texts of very many lines take the time of a sort; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlytics.llm.common import bound, cut, table

MIN_RUN = 2
LONG_LINE = 8
# Anchored and possessive: a line is looked at once.
IS_LONG = rf"^[\x20\x09-\x0D]*+(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]++){{{LONG_LINE - 1}}}[^\x20\x09-\x0D]"


def line_array(text: Column) -> Column:
    return F.split(text, "\n", -1)


def windows(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """A row per window: its place, the places of its lines, its fingerprint and its hashes."""
    hashed = F.transform(
        line_array(F.col("text")),
        lambda line, at: F.struct(
            at.alias("at"), F.xxhash64(line).alias("h"), F.hash(line).alias("g"), (F.trim(line) == "").alias("blank"), line.rlike(IS_LONG).alias("long")
        ),
    )

    def windows_of(lines: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(lines) - min_run + 1)
        runs = F.when(F.size(lines) >= min_run, F.transform(starts, lambda at: F.slice(lines, at, min_run)))
        single = F.transform(F.filter(lines, lambda line: line["long"]), lambda line: F.array(line))
        return F.concat(F.coalesce(runs, F.slice(single, 1, 0)), single)

    lines = F.filter(hashed, lambda line: ~line["blank"])
    each = docs.where("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("sign"), F.explode(bound(lines, windows_of)).alias("window"))
    last_least = F.array_min(F.transform("window", lambda line: F.struct(line["h"], (-line["at"]).alias("back"))))
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "sign", F.col("window")[0]["at"].alias("at"))
    return each.select(
        place.alias("place"),
        F.transform("window", lambda line: line["at"]).alias("ats"),
        last_least["h"].alias("fingerprint"),
        (-last_least["back"]).alias("fingerprint_at"),
        F.xxhash64(F.transform("window", lambda line: line["h"])).alias("w1"),
        F.hash(F.transform("window", lambda line: line["g"])).alias("w2"),
    )


def repeated_lines(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """`doc_id`, `sign` of the text, `gone`: places of the lines that later repeats cover."""
    every = cut(windows(docs, min_run), "windows")
    # A fingerprint's places: one for each line that some window selects.
    anchors = every.groupBy("fingerprint").agg(
        F.min(F.struct("place.nameless", "place.doc_id", "place.sign", "fingerprint_at")).alias("low"),
        F.max(F.struct("place.nameless", "place.doc_id", "place.sign", "fingerprint_at")).alias("high"),
    )
    shared = anchors.where("low != high").select("fingerprint")
    around = every.join(shared, "fingerprint")
    first = around.groupBy("w1", "w2").agg(F.min("place").alias("first"), F.max("place").alias("last")).where("first != last")
    later = around.join(first.drop("last"), ["w1", "w2"]).where(F.col("place") > F.col("first"))
    gone = later.select("place.doc_id", "place.sign", F.explode("ats").alias("at")).distinct()
    return gone.groupBy("doc_id", "sign").agg(F.collect_list("at").alias("gone"))


def lines_left(text: Column, gone: Column) -> Column:
    """The lines between those at the places in `gone`, as slices: each line is touched once."""

    def between(lines: Column, places: Column) -> Column:
        """Slices before each place, and after the last one."""
        before = F.transform(places, lambda at, k: F.coalesce(F.get(places, k - 1), F.lit(-1)))
        slices = F.zip_with(before, places, lambda last, at: F.slice(lines, last + 2, at - last - 1))
        rest = F.slice(lines, F.array_max(places) + 2, F.size(lines))
        return F.concat(F.flatten(slices), rest)

    return bound(line_array(text), lambda lines: bound(F.sort_array(gone), lambda places: between(lines, places)))


def text_left(lines: Column) -> Column:
    """`lines` as a text, empty if all of them are blank, and whether they are."""
    bare = F.forall(lines, lambda line: F.trim(line) == "")
    return F.struct(F.when(bare, "").otherwise(F.array_join(lines, "\n")).alias("text"), bare.alias("bare"))


def dedup_lines(docs: DataFrame, min_run: int = MIN_RUN, drop_emptied: bool = False) -> DataFrame:
    """`docs` with later repeats cut out of `text`; `n_chars`, if there, counts what is left.

    With `drop_emptied`, documents whose lines have all gone go too.
    """
    gone = cut(repeated_lines(docs, min_run), "gone").toDF("_doc_id", "_sign", "_gone")
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.xxhash64("text") == F.col("_sign"))
    # Merged at every size: both sides grow with the documents, so a broadcast would only suit small tables.
    marked = docs.join(gone.hint("merge"), same, "left")
    left = F.when(F.col("_gone").isNotNull(), bound(lines_left(F.col("text"), F.col("_gone")), text_left))
    marked = marked.withColumn("_left", left)
    if drop_emptied:
        marked = marked.where(F.col("_gone").isNull() | ~F.col("_left.bare"))
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.col("_left.text"))
    out = marked.withColumn("text", text).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text")


ORACLE = r"""
WITH l AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents),
n AS (
  SELECT *, lead(line) OVER d AS next, lead(pos) OVER d AS next_pos
  FROM l WHERE trim(line, ' ') <> '' WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
f AS (SELECT *, row_number() OVER (PARTITION BY line, next ORDER BY doc_id, pos) AS k FROM n WHERE next IS NOT NULL),
s AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS k
  FROM n WHERE regexp_matches(line, '([^\x20\x09-\x0D]+[\x20\x09-\x0D]+){7}[^\x20\x09-\x0D]')),
gone AS (
  SELECT doc_id, pos FROM f WHERE k > 1 UNION SELECT doc_id, next_pos FROM f WHERE k > 1 UNION SELECT doc_id, pos FROM s WHERE k > 1),
kept AS (SELECT l.* FROM l ANTI JOIN gone USING (doc_id, pos)),
left_over AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text, bool_and(trim(line, ' ') = '') AS bare FROM kept GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.doc_id NOT IN (SELECT doc_id FROM gone) THEN d.text WHEN coalesce(k.bare, true) THEN '' ELSE k.text END AS text
FROM documents d LEFT JOIN left_over k USING (doc_id)
"""
