import random

from marlstone.llm import spam

WORDS = "porch camera driver parcel door clip label review light guest garden street visitor leaves morning keeps second window record between".split()


def _plain(i):
    r = random.Random(i)
    return " ".join(f"{r.choice(WORDS)} {r.randrange(10**6)} {r.choice(WORDS)} {' '.join(r.sample(WORDS, 6))}.".capitalize() for _ in range(16))


def _tags(i):
    r = random.Random(10_000 + i)
    return "\n".join(f"{r.choice(WORDS)} cam {r.choice(WORDS)} {r.randrange(100)} EUR SKU-{r.randrange(10**4)}" for _ in range(36))


def _found(spark, rows):
    return {r.doc_id for r in spam.spam_pages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}


def test_copies_of_one_spam_text_do_not_become_usual(spark):
    plain = [(i, _plain(i), "en") for i in range(40)]
    tags = [(100 + i, _tags(i), "en") for i in range(10)]
    copies = [(1000 + i, "buy cheap cam " * 80, "en") for i in range(100)]
    expected = {k for k, _, _ in tags + copies}
    assert _found(spark, plain + tags) == {k for k, _, _ in tags}
    assert _found(spark, plain + tags + copies) == expected


def test_many_different_spam_texts_do_not_become_usual(spark):
    plain = [(i, _plain(i), "en") for i in range(40)]
    tags = [(100 + i, _tags(i), "en") for i in range(30)]
    masses = [(1000 + i, f"buy cheap cam{i} " * 75, "en") for i in range(100)]
    assert _found(spark, plain + tags + masses) == {k for k, _, _ in tags + masses}


def test_corpus_without_sentences(spark):
    assert _found(spark, [(i, "buy cheap cam " * 80, "en") for i in range(5)]) == set(range(5))


def _speech(i):
    r = random.Random(20_000 + i)
    return [" ".join("".join(r.choices("abcdefghijklmnoprstuvw", k=r.randrange(3, 9))) for _ in range(9)) for _ in range(16)]


def test_unpunctuated_text_of_usual_redundancy_is_no_spam(spark):
    plain = [(i, " ".join(f"{x.capitalize()}." for x in _speech(i)), "en") for i in range(40)]
    transcripts = [(100 + i, " ".join(_speech(50 + i)), "en") for i in range(5)]
    lists = [(110 + i, "\n".join(_speech(60 + i)), "en") for i in range(5)]
    tags = [(200 + i, _tags(i), "en") for i in range(5)]
    assert _found(spark, plain + transcripts + lists + tags) == {k for k, _, _ in tags}


def test_figures_of_a_table_stay():
    table = "\n".join(",".join(str(7919 * (8 * i + j) % 100_003) for j in range(8)) for i in range(20))
    assert spam.words_of(table) == table.encode()
    assert spam.words_of("chime kit 44.40 EUR SKU-8132") == b"chime kit 0.0 EUR SKU-0"


def test_null_blank_short_and_repeated_rows(spark):
    rows = [(None, None, None), (1, "", "en"), (1, " \n", "en"), (2, "buy buy", "xx"), (3, "spam spam " * 200, None), (3, "spam spam " * 200, None), (4, "字" * 100 + "。", "zh")] + [(100 + i, _plain(i), "en") for i in range(35)]
    df = spark.createDataFrame([(*r, i, "x") for i, r in enumerate(rows)], "doc_id long, text string, lang string, ratio int, is_spam string")
    got = spam.spam_scores(df)
    assert got.count() == len(rows) and [r.doc_id for r in got.filter("is_spam").collect()] == [3, 3]
    assert spam.spam_scores(df.limit(0)).count() == 0 and {r.doc_id for r in spam.spam_pages(df, lang=None).collect()} == {3}


def test_a_very_long_page(spark):
    rows = [(i, _plain(i), "en") for i in range(35)] + [(99, "cheap cam kit " * 100_000, "en"), (98, " ".join(_plain(i) for i in range(300)), "en")]
    assert _found(spark, rows) == {99}
