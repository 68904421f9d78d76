"""Line dedup: removal of lines that spread over many sites.

The sites (column ``source``) on which a line stands are counted by HyperLogLog sketches, one per
line hash, that merge in the aggregation: a task sends one sketch per line, however hot the line.
Lines whose estimate is near the threshold get an exact distinct count. A line on `SITES` sites or
more is boilerplate and goes wherever it stands, but for its first place (smallest doc_id, then
line number): so what many sites have copied stays once in the corpus.

Defined results: lines are split at ``\\n`` and equal only if they are the same text; lines without
a word never count; a NULL source is a site of its own; a NULL text stays NULL and has no lines; a
NULL doc_id comes last in the order; rows equal in doc_id, source and text are treated alike; other
columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import apart, maybe_among, row_key
from salesmart.workspace import Workspace

#: Distinct sites from which on a line is boilerplate.
SITES = 10

#: Sketches have 2**LG_REGISTERS registers: a standard error of 3.25 percent.
LG_REGISTERS = 10

#: Estimates within this part of the threshold, three standard errors, are counted exactly.
BAND = 0.1

LINE = ["_h", "_h2"]
KEY = ["_key", "_key2"]


def _keyed(docs: DataFrame) -> DataFrame:
    kinds = {"doc_id": "bigint", "source": "string", "text": "string"}
    bare = docs.withColumns({f"_{name}": docs[name].cast(kind) for name, kind in kinds.items()})
    key, key2 = row_key("_doc_id", "_source", "_text")
    return bare.withColumn("_key", key).withColumn("_key2", key2)


def lines(docs: DataFrame) -> DataFrame:
    """Hashes, place and site of every line with a word; no text."""
    rows = _keyed(docs).select(
        "_key", "_key2", "_doc_id", F.xxhash64("_source").alias("_site"),
        F.posexplode(F.split("_text", "\n")).alias("_line_no", "_line"),
    ).where(F.col("_line").rlike(r"[^\x20\x09-\x0D]"))
    place = F.struct(
        F.col("_doc_id").isNull().alias("last"), F.col("_doc_id").alias("doc_id"),
        *KEY, F.col("_line_no").alias("line_no"),
    )
    return rows.select(
        F.xxhash64("_line").alias("_h"),
        F.xxhash64(F.lit("second"), "_line").alias("_h2"),
        "_site", "_key", "_key2", "_line_no", place.alias("_place"),
    )


def boilerplate(
    rows: DataFrame, workspace: Workspace, sites: int = SITES, band: float = BAND
) -> DataFrame:
    """(line hash, first place) of the lines that stand on ``sites`` sites or more."""
    spread = rows.groupBy(*LINE).agg(
        F.hll_sketch_agg("_site", F.lit(LG_REGISTERS)).alias("_sketch"),
        F.min("_place").alias("_first"),
    ).withColumn("_sites", F.hll_sketch_estimate("_sketch")).drop("_sketch")
    maybe = workspace.store("maybe", spread.where(F.col("_sites") >= sites * (1 - band)))
    near = maybe.where(F.col("_sites") <= sites * (1 + band))
    exact = (
        rows.join(near.select(*LINE), LINE, "left_semi")
        .groupBy(*LINE, "_site").count()
        .groupBy(*LINE).agg(F.count(F.lit(1)).alias("_exact"))
    )
    decided = maybe.join(exact, LINE, "left")
    wide = F.coalesce("_exact", "_sites") >= sites
    return workspace.store("boilerplate", decided.where(wide).select(*LINE, "_first"))


def without_boilerplate(
    docs: DataFrame, workspace: Workspace, sites: int = SITES, band: float = BAND
) -> DataFrame:
    """``docs`` with the text that is left, and two more columns, n_lines and n_removed."""
    return apart(docs, ["doc_id", "source", "text"],
                 lambda docs: _without_boilerplate(docs, workspace, sites, band))


def _without_boilerplate(
    docs: DataFrame, workspace: Workspace, sites: int, band: float
) -> DataFrame:
    rows = lines(docs)
    found = rows.join(boilerplate(rows, workspace, sites, band), LINE)
    again = found.where(F.col("_place") != F.col("_first"))
    gone = workspace.store(
        "gone", again.groupBy(*KEY).agg(F.collect_set("_line_no").alias("_gone"))
    )
    all_lines = F.split("_text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size("_all") - 1), F.col("_gone"))
    text = F.array_join(F.transform(F.sort_array(kept), lambda i: F.get("_all", i)), "\n")
    keyed = _keyed(docs)
    # Texts that surely lose nothing stay where they are.
    whole = maybe_among(keyed, gone, "_key", "left_anti").withColumn("_gone", F.lit(None).cast("array<int>"))
    perhaps = maybe_among(keyed, gone, "_key").join(gone, KEY, "left").select(*whole.columns)
    result = whole.unionByName(perhaps).withColumn("_all", all_lines).withColumns({
        "n_lines": F.when(F.col("_text").isNull(), 0).otherwise(F.size("_all")).cast("bigint"),
        "n_removed": F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint"),
        "text": F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(text),
    })
    return result.select(*docs.columns, "n_lines", "n_removed")


def op2_line_dedup(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return without_boilerplate(docs, Workspace(spark)).select(
        "doc_id", "n_lines", "n_removed",
        F.sha2("text", 256).alias("kept_sha256"),
    )


OP2_SQL = """
    WITH line AS (
        SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS line_no
        FROM documents
    ), wide AS (
        SELECT line, min({'d': doc_id, 'n': line_no}) AS first
        FROM line WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
        GROUP BY line
        HAVING count(DISTINCT coalesce(source, 'no source')) >= 10
    ), marked AS (
        SELECT line.*, wide.line IS NOT NULL AND first <> {'d': doc_id, 'n': line_no} AS gone
        FROM line LEFT JOIN wide ON line.line = wide.line
    )
    SELECT doc_id, count(*) AS n_lines, count_if(gone) AS n_removed,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT gone), ''))
               AS kept_sha256
    FROM marked GROUP BY doc_id
"""
