import pytest

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


@pytest.fixture
def docs(spark):
    """``docs(texts)``: a documents table; items are texts or (doc_id, text[, lang[, source]])."""

    def make(items, **extra):
        rows = []
        for i, item in enumerate(items):
            doc_id, text, lang, source = ((i, item) if not isinstance(item, tuple) else item) + ("en", "src0")[max(0, len(item) - 2) if isinstance(item, tuple) else 0:]
            rows.append((doc_id, text, lang, source, len(text or "")))
        return spark.createDataFrame(rows, DOCS)

    return make
