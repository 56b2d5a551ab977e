"""Cross-site line removal by distinct-site spread.

Every non-blank line (spaces at its ends aside) gets a HyperLogLog sketch of the sites
it stands on; sketches are built and merged by aggregation, so a line on a third of all
rows shuffles one sketch a task.  Lines whose estimate lies within ``band`` of the
threshold get an exact distinct count; others go by their estimate.  A line that stands on
``min_sites`` sites or more is boilerplate: only its first place (smallest doc_id, then
smallest place) stays.

Null text stays null, with no lines; null sites count for no site; rows alike in id and
text are treated alike; a blank line is never removed; an empty table gives an empty one.
Empty text: one blank line.  Very long texts: cut whole, in time that grows with their
lines.  Ties: places that share the smallest id and number, as rows that share an id can,
all stay.  Extra columns, of any name, are kept in ``_row`` and by ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evwin.llm.common import packed, row_key
from evwin.session import materialize

#: A line on so many distinct sites is boilerplate.
MIN_SITES = 10
#: 2**LG_K buckets a sketch: a standard error of 1.04 / sqrt(2**LG_K), 1.6 %.
LG_K = 12
#: Estimates nearer to the threshold than this share of it are counted exactly: over 3 standard errors.
BAND = 0.06


def _lines(docs: DataFrame, site: str) -> DataFrame:
    """doc_id, rk, pos, site and two hashes (128 bits) of each non-blank line."""
    keyed = docs.select("doc_id", row_key().alias("rk"), F.col(site).alias("site"), "text")  # hashed once a text, not once a line
    cut = keyed.select("doc_id", "rk", "site", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    line = F.trim("line")
    return cut.filter(line != "").select("doc_id", "rk", "site", "pos", F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2"))


def boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """h1, h2, sites (estimate, or exact count near the threshold), first (its first place)."""
    lines = _lines(docs, site)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "pos")
    spread = lines.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"), F.min(place).alias("first"))
    estimate = F.hll_sketch_estimate("sketch").cast("double")
    likely = materialize(spread.select("h1", "h2", "first", estimate.alias("sites")).filter(F.col("sites") > min_sites * (1 - BAND) - 0.5), "spread")
    unsure = F.abs(F.col("sites") - min_sites) <= min_sites * BAND + 0.5
    near = likely.filter(unsure)
    exact = lines.join(near.select("h1", "h2"), ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(F.countDistinct("site").cast("double").alias("sites"))
    counted = near.drop("sites").join(exact, ["h1", "h2"]).select("h1", "h2", "first", "sites").filter(F.col("sites") >= min_sites)
    return likely.filter(~unsure).filter(F.col("sites") >= min_sites).unionByName(counted)


def _removed(docs: DataFrame, site: str, min_sites: int) -> DataFrame:
    """doc_id, rk and the places of the lines that go, of documents that lose any."""
    hits = _lines(docs, site).join(boilerplate(docs, site, min_sites).select("h1", "h2", "first"), ["h1", "h2"])
    first = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.pos") == F.col("pos"))
    return hits.filter(~first).groupBy("doc_id", "rk").agg(F.collect_set("pos").alias("gone"))


def _kept(text: Column, gone: Column) -> Column:
    """The lines of a text whose places are not in ``gone``: in time that grows with its
    lines, as places are set apart by hashing and lines taken by number."""
    def rest(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(places, lambda i: F.element_at(lines, i + 1)), "\n")
    once = F.transform(F.array(F.split(text, "\n", -1)), rest)  # split once, whatever the number of lines
    return F.when(gone.isNull(), text).otherwise(F.element_at(once, 1))


def dedup_lines(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``_row`` (the document's columns), doc_id, n_lines (blank ones too), n_removed and
    kept (the text without the lines that go)."""
    gone = materialize(_removed(docs, site, min_sites), "boilerplate")
    rows = packed(docs, doc_id=F.col("doc_id"), rk=row_key())
    text = F.col("_row").getField("text")
    # the lists of places grow with the documents: the same plan at every size
    lists = gone.select(F.col("doc_id").alias("g"), F.col("rk").alias("grk"), "gone").hint("merge")
    joined = rows.join(lists, F.col("doc_id").eqNullSafe(F.col("g")) & (F.col("rk") == F.col("grk")), "left")
    n = F.when(text.isNull(), 0).otherwise(F.size(F.split(text, "\n", -1)))
    return joined.select("_row", "doc_id", n.cast("long").alias("n_lines"), F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_removed"), _kept(text, F.col("gone")).alias("kept"))


def clean(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with cut texts and their ``n_chars``; a document all of whose text went goes."""
    cut = dedup_lines(docs, site, min_sites).filter((F.col("n_removed") == 0) | F.col("kept").rlike(r"\S"))
    changed = {"text": F.col("kept"), "n_chars": F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col("_row.n_chars") if "n_chars" in docs.columns else F.lit(None))}
    kinds = dict(docs.dtypes)
    return cut.select(*[(changed[c].cast(kinds[c]) if c in changed else F.col("_row").getField(c)).alias(c) for c in docs.columns])
