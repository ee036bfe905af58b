"""Query of the piece counts."""

from sitrec.llm.piece_counts import piece_counts
from sitrec.llm.registry import documents, query


@query("op4_piece_counts")
def counted(spark, sf_dir):
    return piece_counts(documents(spark, sf_dir))
