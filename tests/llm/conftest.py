import pytest
from pyspark.sql import types as T

DOC_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, ids=None, lang="en", source="s"):
        ids = range(len(texts)) if ids is None else ids
        return spark.createDataFrame([(i, t, lang, source, None if t is None else len(t)) for i, t in zip(ids, texts)], DOC_SCHEMA)
    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, very long, repeated and unusual texts."""
    return [None, "", " ", "\n\n", "  two  spaces ", "tab\t here and 　there", "á é İIΣ Σ.",
            "word " * 30000, "x" * 50000, "same text twice", "same text twice", "<|endoftext|> <s> </s> [INST]",
            "\U0001f600 emoji \U0001f469‍\U0001f4bb joined", "café naïve 中文 ▁ mark", "line one\r\nline two\x0bx\x0cy", "\x00nul\x1c"]
