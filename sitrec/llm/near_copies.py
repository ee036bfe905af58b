"""The near-duplicate stage: one row of each group of near copies, with all its columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitrec.llm.columns import numbered, quoted, text_or_empty, without
from sitrec.llm.exact_dedup import filter_bits
from sitrec.llm.joins import maybe_among
from sitrec.llm.set_dedup import Rule, set_classes
from sitrec.llm.simhash import row_classes
from sitrec.storage import written

PERCENT, ROWS, BANDS = 80, 6, 42


def near_copies(docs: DataFrame, shingle: int = 5, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` with all their columns (but for a clashing ``_row``), one of each group of near copies.

    Texts are linked if the sets of their shingles of ``shingle`` words have a Jaccard similarity of 0.8 or more;
    every link is verified on the sets of 64-bit hashes of all shingles.  Candidates are linked by their SimHash
    fingerprints (four-word shingles, four bits at most), or, as those miss most pairs near 0.8, share a band of SetSketch
    registers; at 0.8 itself one pair in 350,000 shares none, above it fewer.  Groups are what links reach.  Of a group
    the row with the smallest id (null ids last) stays, of those the first in the order of the input.  Texts
    without words are equal, as a null text is.  Rows that repeat an id are separate rows.  An empty table gives
    no rows.

    Only texts that share a band move, as do texts of rows that may have to go.
    """
    clean = without(docs, ["_row"])
    columns = [quoted(c) for c in clean.columns]
    rows = numbered(clean)
    plain = rows.select(quoted(doc_id).alias("doc_id"), "_row", text_or_empty(text).alias("text"))
    alike = row_classes(plain)
    found = written(set_classes(plain, Rule(shingle, PERCENT, ROWS, BANDS), alike), "found")
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "_row")).alias("top")
    stay = found.groupBy("root").agg(smallest).select(F.col("top._row").alias("_row"))
    gone = written(found.select("_row").join(stay.hint("merge"), "_row", "left_anti"), "gone")
    looked = maybe_among(rows, F.col("_row"), gone, filter_bits(found.count()))
    some = looked.where("_maybe").join(gone.hint("merge"), "_row", "left_anti")
    return looked.where("not _maybe").select(*columns).unionByName(some.select(*columns))
