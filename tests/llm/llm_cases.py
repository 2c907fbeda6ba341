import pytest

from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def corpus(spark):
    """Rows with the shape of documents from a list of texts; doc_id follows the order."""
    def make(texts, ids=None, partitions=3):
        rows = [(i, t, "en", "s", None if t is None else len(t))
                for i, t in zip(ids if ids is not None else range(len(texts)), texts, strict=True)]
        return spark.createDataFrame(rows, DOCUMENTS).repartition(partitions)
    return make


WORDS = [f"{a}{b}{c}" for a in ("re", "so", "mi", "ta") for b in ("lan", "dor", "vex") for c in ("a", "en", "ist", "o")]


@pytest.fixture(scope="session")
def odd_texts():
    """What every operator has to take: null, empty, blanks only, ties, repeats, odd characters, one very long text."""
    return [None, "", " ", "\n\n\t ", "a", "A", "a", "ÀÉ é Ǆ ß İ ﬁ １ ½", "x" * 5000, "emoji 👩‍👩‍👧 𝔘nicode ́ ‍ end",
            "<|endoftext|> <s>x</s> ▁ ▁▁ a▁b", "tab\tand\x0bvertical\x0cform\r\nline  double   triple", "\x00\x01 control \x1f \x85 \xa0",
            " ".join(WORDS[i * 7 % 48] for i in range(6000)), "the the the the the the", "it's I'LL we've 123 4.5 don't!!! ???"]
