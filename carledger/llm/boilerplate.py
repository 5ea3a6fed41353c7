"""Operator 10, line dedup by the number of distinct sites that show a line. DataFrame operations only.

A line is named by 128 bits of hashes. Its sites are counted by HyperLogLog sketches, which merge in the shuffle, so a line
of any number of documents sends one sketch for each map task. Estimates beyond a band around `SITES` decide; lines inside
the band are counted exactly. A document loses its lines that are on SITES sites or more, whatever their share. Only one
that would be left without any line that is not blank stays as it is: it is a copy of others as a whole, and left to
near-duplicate removal. The lines of a text to remove are found by the hash of the whole text, not by doc_id, so a doc_id or a
missing one that very many rows share is no group.

Cases: blank lines are neither counted nor removed; a null source is no site; null and empty texts stay as they are;
repeated rows are treated alike and count once for a site; a long text is split whole; documents with equal or null doc_id
keep apart; columns of any other name are passed through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carledger.llm.tables import free_name

SITES = 10  # distinct sites that make a line boilerplate
BAND = 0.25  # estimates within this share of SITES are replaced by exact counts
SKETCH_LOG2 = 10  # size of a sketch


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _name(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("h1"), F.xxhash64(line, F.lit(1)).alias("h2"))


def widespread(docs: DataFrame, site: str = "source", sites: int = SITES) -> DataFrame:
    """h1, h2 of the lines that occur on `sites` distinct sites or more."""
    lines = docs.select(F.col(site).cast("string").alias("site"), F.explode(_lines(F.col("text"))).alias("line"))
    lines = lines.where("trim(line) != '' and site is not null").select("site", _name(F.col("line")).alias("l")).select("site", "l.*")
    counted = lines.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", SKETCH_LOG2).alias("sketch"), F.count("*").alias("n"))
    counted = counted.where(F.col("n") >= sites)  # occurrences bound the sites
    counted = counted.select("h1", "h2", F.hll_sketch_estimate("sketch").alias("estimate"))
    sure = counted.where(F.col("estimate") > sites * (1 + BAND)).select("h1", "h2")
    close = counted.where(F.col("estimate").between(int(sites * (1 - BAND)), sites * (1 + BAND))).select("h1", "h2")
    exact = lines.join(close, ["h1", "h2"], "left_semi").distinct().groupBy("h1", "h2").agg(F.count("*").alias("n"))
    return sure.union(exact.where(F.col("n") >= sites).select("h1", "h2"))


def remove_boilerplate(docs: DataFrame, site: str = "source", sites: int = SITES) -> DataFrame:
    """`docs` without boilerplate lines, and n_lines (blank lines included) and n_removed of each row."""
    spread = widespread(docs, site, sites)
    named = docs.select(_name(F.col("text")).alias("_of"), F.explode(F.array_distinct(_lines(F.col("text")))).alias("line"))
    named = named.where("trim(line) != ''").select("_of", _name(F.col("line")).alias("l")).select("_of", "l.*")
    held = named.join(spread, ["h1", "h2"]).groupBy("_of").agg(F.collect_set(F.struct("h1", "h2")).alias("_spread"))
    # The row is kept as one value, so that its names meet no others.
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    joined = rows.join(held, _name(F.col("_row.text")) == F.col("_of"), "left")
    own, text = F.col("_row"), F.col("_row.text")
    here = F.coalesce(F.col("_spread"), F.array().cast("array<struct<h1: bigint, h2: bigint>>"))
    # Most documents hold no such line; their texts are not taken apart.
    kept = F.when(F.col("_spread").isNull(), _lines(text)).otherwise(
        F.filter(_lines(text), lambda line: ~((F.trim(line) != "") & F.array_contains(here, _name(line))))
    )
    rest = F.array_join(kept, "\n")
    whole = ~F.exists(kept, lambda line: F.trim(line) != "")
    some = F.struct(F.size(_lines(text)).alias("n"), F.size(kept).alias("kept"), whole.alias("whole"), rest.alias("rest"))
    found = joined.select("_row", F.when(text.isNotNull(), some).alias("_cut"))
    cut = F.col("_cut")
    changed = F.when(cut.isNull() | cut["whole"], text).otherwise(cut["rest"])
    n_lines = F.coalesce(cut["n"], F.lit(0))
    n_removed = F.when(cut.isNull() | cut["whole"], 0).otherwise(cut["n"] - cut["kept"])
    passed = [changed.alias(c) if c == "text" else own[c].alias(c) for c in docs.columns]
    return found.select(*passed, n_lines.cast("long").alias("n_lines"), n_removed.cast("long").alias("n_removed"))


def cleaned(docs: DataFrame) -> DataFrame:
    """`docs` with the same columns, without boilerplate lines; n_chars, where there is one, is that of the new text."""
    own = {c: free_name(f"_own_{c}", docs) for c in ("n_lines", "n_removed") if c in docs.columns}
    found = remove_boilerplate(docs.withColumnsRenamed(own)).drop("n_lines", "n_removed")
    found = found.withColumnsRenamed({v: k for k, v in own.items()})
    if "n_chars" in docs.columns:
        count = F.when(F.col("text").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("n_chars", F.coalesce(count, F.col("n_chars")))
    return found.select(*docs.columns)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, how many lines each document had and lost, and the length and SHA-256 of what remains."""
    cleaned = remove_boilerplate(docs.select("doc_id", "text", "source"))
    text = F.coalesce("text", F.lit(""))
    return cleaned.select(
        "doc_id", "n_lines", "n_removed", F.length(text).cast("long").alias("n_chars"), F.sha2(text, 256).alias("text_sha256")
    )


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents
), spread AS (
  SELECT line FROM lines WHERE trim(line) <> '' AND source IS NOT NULL
  GROUP BY line HAVING count(DISTINCT source) >= 10
), held AS (
  SELECT doc_id, list(DISTINCT line) AS ls FROM lines SEMI JOIN spread USING (line) GROUP BY doc_id
), cut AS (
  SELECT d.doc_id, coalesce(d.text, '') AS text, string_split(d.text, chr(10)) AS all_lines,
    list_filter(string_split(d.text, chr(10)), lambda x: NOT list_contains(coalesce(h.ls, []), x)) AS kept
  FROM documents d LEFT JOIN held h ON d.doc_id IS NOT DISTINCT FROM h.doc_id
), judged AS (
  SELECT *, coalesce(array_to_string(kept, chr(10)), '') AS rest,
    len(list_filter(kept, lambda x: trim(x) <> '')) = 0 AS whole
  FROM cut
)
SELECT doc_id, coalesce(len(all_lines), 0)::BIGINT AS n_lines,
  CASE WHEN whole THEN 0 ELSE coalesce(len(all_lines) - len(kept), 0) END::BIGINT AS n_removed,
  length(CASE WHEN whole THEN text ELSE rest END)::BIGINT AS n_chars,
  sha256(CASE WHEN whole THEN text ELSE rest END) AS text_sha256
FROM judged
"""
