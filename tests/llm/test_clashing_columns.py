"""Extra columns of documents with names that the operators use inside change no result."""

import pytest
from pyspark.sql import functions as F

from shelfcount.llm import queries
from tests.llm.test_pipeline import tables

EXTRA = ["__id", "__th", "__hash", "__score", "__spans", "__known", "raw", "print", "host", "key", "band", "tag", "norm",
         "size", "label", "rank", "score", "n"]
OF_DOCUMENTS = ["op1_suffix_dedup", "op2_quality_classifier", "op3_byte_bpe", "op5_simhash", "op6_token_counts",
                "op7_licences", "op8_decontamination", "op9_exact_dedup", "op11_fill_in_middle", "op12_packing",
                "op13_merkle_manifest"]


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    plain, clashing, empty = (str(tmp_path_factory.mktemp(n)) for n in ("plain", "clashing", "empty"))
    for folder in (plain, clashing, empty):
        tables(spark, f"{folder}/in")
        docs = spark.read.parquet(f"{folder}/in/documents.parquet").drop("kept")
        for n, name in enumerate(EXTRA if folder == clashing else []):
            docs = docs.withColumn(name, F.lit(n).cast("string"))
        docs = docs.limit(0) if folder == empty else docs
        docs.write.parquet(f"{folder}/documents.parquet")
        for name in ("labels", "benchmark"):
            spark.read.parquet(f"{folder}/in/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return plain, clashing, empty


@pytest.mark.parametrize("name", OF_DOCUMENTS)
def test_clashing_names_and_no_documents(spark, folders, name):
    plain, clashing, empty = (queries.QUERIES[name](spark, folder) for folder in folders)
    assert plain.columns == clashing.columns == empty.columns
    assert sorted(map(str, plain.collect())) == sorted(map(str, clashing.collect()))
    assert plain.count() > 0 and empty.count() == 0
