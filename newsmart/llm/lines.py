"""Line de-duplication by the spread of a line over sites.

A line that stands on ``MIN_SITES`` distinct sites or more is boilerplate and stays
at one place only: in the row of the smallest id (then of a hash of the row), where it
first stands there.  Lines are compared without the white space around them; empty ones stay.

Each task sums up a HyperLogLog sketch of the sites per line hash, and the
sketches merge by aggregation, so a line in a third of all documents reaches its
reducer as one sketch per task.  Estimates well off the threshold decide by
themselves; lines within ``BAND`` times the sketch's standard error of it get an exact
distinct count of their sites.

Only hashes, ids and sketches are shuffled; the texts are joined once with the
lines each document loses.  Null text stays null and a document that loses all
lines has an empty text; null sites count as one site.  Losses are those of a row, not of
an id: rows that share an id, or have none, are told apart by text and site, and of
rows alike in all three one keeps the line.  Further columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsmart.llm.common import row_key, stored

#: Sites on which a line must stand to count as boilerplate.
MIN_SITES = 4
#: Registers of a sketch, as a power of two, and its relative standard error.
LOG2_REGISTERS = 10
ERROR = 1.04 / 2 ** (LOG2_REGISTERS / 2)
#: Standard errors around the threshold that are counted exactly.
BAND = 5


def _split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _bare(line: Column) -> Column:
    return F.regexp_replace(line, r"^\s+|\s+$", "")


def _key(line: Column) -> Column:
    """128 bits of a line, as two longs."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def _row(docs: DataFrame) -> Column:
    return row_key(docs, "source")


def lines(docs: DataFrame) -> DataFrame:
    """row, id, site, place and key of every line that is not empty."""
    return (
        docs.select(
            _row(docs).alias("row"),
            docs["doc_id"].alias("id"),
            F.coalesce(docs["source"].cast("string"), F.lit("")).alias("site"),
            F.posexplode(_split(docs["text"])).alias("place", "line"),
        )
        .withColumn("line", _bare(F.col("line")))
        .where("line != ''")
        .select("row", "id", "site", "place", _key(F.col("line")).alias("key"))
    )


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """key and its first place (``row``, ``place``) of every line on so many sites."""
    near = BAND * ERROR * min_sites + 0.5
    seen = lines(docs)
    spread = (
        seen.groupBy("key")
        .agg(
            F.hll_sketch_agg("site", F.lit(LOG2_REGISTERS)).alias("sketch"),
            # Null ids come last; row and place break ties.
            F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row", "place")).alias("first"),
            F.count("*").alias("n"),
        )
        .where(F.col("n") >= min_sites)
        .withColumn("sites", F.hll_sketch_estimate("sketch"))
        .where(F.col("sites") > min_sites - near)
        .select("key", "first.row", "first.place", "sites")
    )
    held = stored(spread, "line-spread")
    close = held.where(F.col("sites") < min_sites + near).select("key")
    enough = F.col("sites") >= min_sites
    if close.head(1):  # else no text is read for it
        exact = (
            seen.join(close, "key", "left_semi")
            .groupBy("key", "site")
            .agg(F.lit(1).alias("one"))
            .groupBy("key")
            .agg(F.sum("one").alias("exact"))
        )
        held = held.join(exact, "key", "left")
        enough = F.when(F.col("exact").isNotNull(), F.col("exact") >= min_sites).otherwise(enough)
    return stored(held.where(enough).select("key", "row", "place"), "boilerplate")


def _without(docs: DataFrame, gone: Column) -> list[Column]:
    """The columns of ``docs`` without the lines that stand at ``gone``, a set of (place, key) or null."""
    kept = F.filter(
        F.transform(_split(docs["text"]), lambda line, i: F.struct(line.alias("line"), i.alias("i"))),
        lambda x: ~F.array_contains(gone, F.struct(x["i"].alias("place"), _key(_bare(x["line"])).alias("key"))),
    )
    changed = gone.isNotNull() & docs["text"].isNotNull()
    new = {"text": F.array_join(F.transform(kept, lambda x: x["line"]), "\n")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(new["text"]).cast(docs.schema["n_chars"].dataType)
    return [F.when(changed, new[c]).otherwise(docs[c]).alias(c) if c in new else docs[c] for c in docs.columns]


def dedup(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) without boilerplate lines; all columns stay.

    ``n_chars`` follows the text where there is one.
    """
    common = boilerplate(docs, min_sites).select(
        "key", F.col("row").alias("first_row"), F.col("place").alias("first_place")
    )
    lost = (
        lines(docs)
        .join(common, "key")
        .where((F.col("row") != F.col("first_row")) | (F.col("place") != F.col("first_place")))
        .groupBy(F.col("row").alias("_row"))
        .agg(F.collect_set(F.struct("place", "key")).alias("_lost"))
    )
    lost = stored(lost, "lost-lines")
    firsts = common.groupBy(F.col("first_row").alias("_row")).agg(
        F.collect_set(F.struct(F.col("first_place").alias("place"), "key")).alias("_firsts")
    )
    rows = docs.select(_row(docs).alias("_row"))
    twins = stored(
        rows.join(firsts, "_row", "left_semi").groupBy("_row").agg(F.count("*").alias("n")).where("n > 1"), "twin-rows"
    )
    if not twins.head(1):
        return docs.join(lost, _row(docs) == lost["_row"], "left").select(*_without(docs, lost["_lost"]))
    single = docs.join(twins, _row(docs) == twins["_row"], "left_anti")
    one = single.join(lost, _row(single) == lost["_row"], "left").select(*_without(single, lost["_lost"]))
    # Rows alike in id, text and site: the first place is in one of them only.
    told = docs.join(twins, _row(docs) == twins["_row"], "left_semi").select(
        F.struct(*docs.columns).alias("doc"), _row(docs).alias("_row"), F.monotonically_increasing_id().alias("_twin")
    )
    told = stored(told, "twins")
    lead = told.groupBy("_row").agg(F.min("_twin").alias("_lead"))
    gone = F.when(F.col("_twin") == F.col("_lead"), F.col("_lost")).otherwise(
        F.array_union(F.coalesce("_lost", F.array().cast(lost.schema["_lost"].dataType)), "_firsts")
    )
    name = "_gone"
    while name in docs.columns:
        name += "_"
    both = told.join(lead, "_row").join(firsts, "_row").join(lost, "_row", "left").select("doc.*", gone.alias(name))
    return one.unionByName(both.select(*_without(both.drop(name), both[name])))


ORACLE_SQL = f"""
with cut as (
  select doc_id, source, text, unnest(string_split(text, chr(10))) as line,
         generate_subscripts(string_split(text, chr(10)), 1) as place
  from documents
), bare as (
  select *, regexp_replace(line, '^[ \\t\\n\\x0B\\f\\r]+|[ \\t\\n\\x0B\\f\\r]+$', '', 'g') as key from cut
), spread as (
  select key, min((doc_id, place)) as first from bare where key <> ''
  group by key having count(distinct coalesce(source, '')) >= {MIN_SITES}
), kept as (
  select doc_id, string_agg(line, chr(10) order by place) as text
  from bare left join spread using (key)
  where first is null or first = (doc_id, place)
  group by doc_id
)
select d.doc_id, case when d.text is null then null else coalesce(k.text, '') end as text,
       d.lang, d.source,
       case when d.text is not distinct from k.text then d.n_chars else length(coalesce(k.text, '')) end as n_chars
from documents d left join kept k using (doc_id)"""
