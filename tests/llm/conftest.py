import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {
    "en": "the and of with this river stone garden paper window morning evening people water light",
    "de": "der und mit von nicht haus garten wasser morgen abend leute fenster strasse licht brot",
    "fr": "le et de avec pas maison jardin matin soir gens eau pierre rue pain pour",
}


def sentence(lang: str, n: int, seed: int) -> str:
    import random

    r = random.Random(seed)
    return " ".join(r.choice(WORDS[lang].split()) + r.choice(["", "", "", "er", "ing", "s"]) for _ in range(n))


@pytest.fixture(scope="session")
def corpus(spark):
    """A small table of documents with the awkward cases."""
    rows = []
    for i in range(60):
        lang = list(WORDS)[i % 3]
        rows.append((i, sentence(lang, 30 + i, i).capitalize() + ".\n" + sentence(lang, 12, 1000 + i), lang, f"src{i % 4}", 0))
    rows += [
        (60, rows[0][1], "en", "src0", 0),  # exact copy
        (61, rows[3][1] + " extra", "en", "src0", 0),  # near copy
        (61, rows[3][1] + " extra", "en", "src0", 0),  # repeated row
        (62, None, None, None, None),
        (63, "", "en", "", 0),
        (64, "12 34 -- ##", "de", "x", 0),
        (65, "x" * 5000 + " " + sentence("en", 4000, 5), "en", "x", 0),  # very long text, very long word
        (None, sentence("fr", 25, 77), "fr", None, None),
        (66, "one two", None, "x", 0),
        (67, "a\n\n\x0b \t", "fr", "x", 0),
    ]
    return spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.fixture(scope="session")
def clashing(corpus):
    """The corpus with extra columns named like the operators' own."""
    from pyspark.sql import functions as F

    out = corpus
    for c in ("fp", "cell", "rep", "uid", "h", "tf", "v0", "s0", "component_id", "kept", "score", "lang_pred", "held_out",
              "_text", "_keep", "_n", "item_id", "piece", "length", "n_words", "c0", "c1"):
        out = out.withColumn(c, F.lit(7))
    return out


@pytest.fixture(scope="session")
def empty(corpus):
    return corpus.limit(0)


@pytest.fixture(scope="session")
def sf_dir(spark, corpus, tmp_path_factory):
    """The small corpus as tables on disk."""
    d = tmp_path_factory.mktemp("tables")
    corpus.write.parquet(f"{d}/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in corpus.collect()}
    items = [(1, text[6][:120]), (2, "this benchmark item stands nowhere in the corpus at all"), (3, None), (None, "short one")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    labels = [(i, 1, 0) for i in range(0, 40)] + [(64, 0, 0), (62, 0, 1), (63, 0, 0), (67, 0, 0), (999, 0, 0), (None, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return str(d)
