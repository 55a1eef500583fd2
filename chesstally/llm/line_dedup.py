"""Line dedup by distinct-site spread, in DataFrame functions only.

A line's spread is the number of distinct sites (``source``) on which it occurs; beside it counts the
number of different documents (texts) that hold it, so that copies of one document on several sites
do not make its lines boilerplate. HyperLogLog sketches of both per line hash are built and merged by
one aggregation; a line whose estimates are clearly below or above the thresholds is decided by them,
and a line near a threshold by an exact distinct count of what is near. A line on ``min_sites`` sites or
more, in ``min_texts`` different documents or more, is cross-site boilerplate: its first occurrence
(smallest doc_id, then position) stays and all others are removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chesstally.llm.common import fresh, materialize, text_of

#: The least spread that is more than a pair of mirrors, in as many different documents (the README has
#: counts of lines per number of sites).
MIN_SITES, MIN_TEXTS = 3, 3
#: Estimates outside threshold * (1 +- BAND) decide by themselves: at lg_k 12 the sketch's relative
#: standard error is below 2 %, so the band is over ten of them wide.
BAND = 0.25
LG_K = 12
_LAST = 2**63 - 1  # rows without a doc_id come after all others


def _lines(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """One row per non-blank line: the document's key, site, position and a 128-bit line hash."""
    text = text_of(text_col)
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("id"), F.xxhash64(text).alias("th"),
        F.coalesce(F.col(site_col).cast("string"), F.lit("")).alias("site"),
        F.posexplode(F.split(text, "\n")).alias("pos", "raw"))
    line = F.trim(F.col("raw"), F.lit(" \t\r"))
    return rows.where(line != "").select(
        "id", "th", "site", "pos", F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2"))


def boilerplate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      site_col: str = "source", min_sites: int = MIN_SITES,
                      min_texts: int = MIN_TEXTS) -> DataFrame:
    """``(h1, h2, first)``: hashes of the lines on ``min_sites`` or more sites and in ``min_texts`` or more
    different texts, first occurrence."""
    lines = _lines(docs, id_col, text_col, site_col)
    least = {"site": min_sites, "th": min_texts}
    stats = (lines.groupBy("h1", "h2")
             .agg(*(F.hll_sketch_agg(c, F.lit(LG_K)).alias(f"sketch_{c}") for c in least),
                  F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "pos")).alias("first"))
             .where(F.col("n") >= max(least.values()))
             .select("h1", "h2", "first", *(F.hll_sketch_estimate(f"sketch_{c}").alias(c) for c in least)))
    for c, most in least.items():
        stats = stats.where(F.col(c) >= most * (1 - BAND))
    stats = materialize(stats, "line-spread")
    out = stats
    for c, most in least.items():  # exact where the estimate is near: few distinct values per line
        near = stats.where(F.col(c) <= most * (1 + BAND)).select("h1", "h2")
        few = (lines.join(near, ["h1", "h2"], "left_semi").select("h1", "h2", c).distinct()
               .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < most))
        out = out.join(few, ["h1", "h2"], "left_anti")
    return out.select("h1", "h2", "first")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                site_col: str = "source", min_sites: int = MIN_SITES, min_texts: int = MIN_TEXTS,
                counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with the repeated occurrences of boilerplate lines removed from the text; all columns
    and rows stay. ``counts`` names two more columns (that ``docs`` lacks), the number of lines and of
    removed lines.

    Lines compare after trimming spaces, tabs and carriage returns; blank lines are never removed.
    A null text is the empty text (one blank line); a null site is a site of its own; rows without a
    doc_id come last in the order of occurrences, and rows that repeat a doc_id and text are treated
    alike; an empty table gives an empty result.
    """
    boiler = materialize(boilerplate_lines(docs, id_col, text_col, site_col, min_sites, min_texts), "line-boiler")
    drops = (_lines(docs, id_col, text_col, site_col).join(boiler, ["h1", "h2"])
             .where("not (id = first.id and pos = first.pos)")
             .groupBy("id", "th").agg(F.collect_set("pos").alias("drop")))
    i, t, d = fresh(docs, "dedup_id"), fresh(docs, "dedup_text"), fresh(docs, "dedup_drop")
    drops = drops.select(F.col("id").alias(i), F.col("th").alias(t), F.col("drop").alias(d))
    keyed = (docs.withColumn(i, F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)))
             .withColumn(t, F.xxhash64(text_of(text_col))))
    lines = F.split(text_of(text_col), "\n")
    # The one-element array binds the split text, so it is cut once and not once per line.
    kept = F.transform(F.array(lines), lambda ls: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col(d)), lambda at: F.get(ls, at)),
        "\n"))[0]
    out = keyed.join(drops, [i, t], "left")
    cols = [F.when(F.col(d).isNull(), F.col(c)).otherwise(kept).alias(c) if c == text_col else F.col(c)
            for c in docs.columns]
    if counts:
        cols += [F.size(lines).cast("long").alias(counts[0]),
                 F.coalesce(F.size(d), F.lit(0)).cast("long").alias(counts[1])]
    return out.select(*cols)


#: DuckDB: the cleaned text of every document, spread counted exactly.
ORACLE = f"""
WITH parts AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS held, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (
  SELECT doc_id, source, held, unnest(ls) AS raw, generate_subscripts(ls, 1) AS pos FROM parts),
t AS (
  SELECT *, trim(raw, ' ' || chr(9) || chr(13)) AS line FROM l),
boiler AS (
  SELECT line, min((doc_id, pos)) AS first FROM t WHERE line <> ''
  GROUP BY line HAVING count(DISTINCT coalesce(source, '')) >= {MIN_SITES} AND count(DISTINCT held) >= {MIN_TEXTS}),
k AS (
  SELECT t.doc_id, t.pos, t.raw, b.line IS NOT NULL AND (t.doc_id, t.pos) <> b.first AS gone
  FROM t LEFT JOIN boiler b ON t.line = b.line)
SELECT doc_id, coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
       count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed
FROM k GROUP BY doc_id
"""
