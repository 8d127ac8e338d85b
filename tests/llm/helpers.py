"""Small tables for the tests of the operators, and what any operator has to bear."""

from pyspark.sql import SparkSession

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = (
    "The river ran past the old mill and the children came down to the water each morning to watch the boats go by, "
    "while the miller stood at his door and counted the sacks that the carts had brought in from the farms on the hill."
)
OTHER = (
    "A letter arrived on Tuesday with three stamps and no name on it, so the postman asked at every house in the street "
    "until a woman with a green hat said that it was hers and paid him for his trouble with a basket of ripe pears."
)


def odd_documents(spark: SparkSession):
    """Nulls in all columns, empty and blank texts, ties, repeated rows, a long text, and clashing column names."""
    rows = [
        (1, PROSE, "en", "a", len(PROSE)),
        (1, PROSE, "en", "a", len(PROSE)),
        (2, PROSE.replace("boats", "ships"), "en", None, 1),
        (3, None, None, None, None),
        (None, None, "en", "a", None),
        (None, PROSE, "en", "a", 5),
        (4, "", "de", "b", 0),
        (5, " \n\t ", None, "b", 4),
        (6, OTHER, "en", "b", None),
        (7, (PROSE + " " + OTHER + "\n") * 120, "en", "b", 7),
        (8, "x" * 6_000, "", "", 8),
        (9, "Grüße, 世界! 😀 <|endoftext|> ok<|endoftext|>", "de", "b", 9),
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


def no_documents(spark: SparkSession):
    return spark.createDataFrame([], DOCUMENTS)


def with_clash(docs, *names: str):
    """``docs`` with extra columns of these names."""
    from pyspark.sql import functions as F

    return docs.withColumns({n: F.lit("own") for n in names})


def write_tables(folder: str, docs, **others) -> str:
    docs.write.parquet(f"{folder}/documents.parquet")
    for name, df in others.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return folder
