"""Query of the token files."""

from sitrec.llm.registry import documents, query
from sitrec.llm.token_files import token_files


@query("op8_token_files")
def files(spark, sf_dir):
    return token_files(documents(spark, sf_dir))
