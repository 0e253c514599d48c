from pyspark.sql import functions as F

from marlstone.llm import languages

SAME = "The courier leaves a small box on the mat and walks back to the street."
GERMAN = ["Der Fahrer stellt ein Paket vor die Haustür.", "Die Nachbarin wartet neben dem Briefkasten.", "Ein Kind fährt mit dem Roller über den Hof.", "Der Mann trägt eine Jacke und klingelt zweimal."]


def test_copies_of_one_text_do_not_fill_the_sample(spark):
    # the copied text ranks first or the German ones do; either way a sample of five holds all five texts
    rows = [(i, SAME, "en") for i in range(40)] + [(100 + i, t, "de") for i, t in enumerate(GERMAN)]
    df = spark.createDataFrame(rows, "pos long, text string, lang string")
    first = df.orderBy(F.xxhash64("text")).limit(5).select("text").distinct().count()
    got = {r.pos: [s.lang for s in r.segments] for r in languages.language_segments(df, sample=5).collect()}
    assert first < 5 and got == {p: [g] for p, _, g in rows}


ENGLISH = ["The driver puts a parcel on the step.", "A neighbour waits next to the mailbox.", "A child rides a scooter across the yard.", "The man wears a jacket and rings twice."]
SPANISH = ["El conductor deja un paquete en la puerta.", "La vecina espera junto al buzón.", "Un niño cruza el patio con su patinete.", "El hombre lleva una chaqueta y llama dos veces."]


def _fitted(spark, extra):
    rows = [(f"{a} {b}", g) for g, ts in (("en", ENGLISH), ("de-DE", GERMAN), ("Spanish", SPANISH)) for a in ts for b in ts for _ in range(2)]
    df = spark.createDataFrame([(i, t, g, "mine") for i, (t, g) in enumerate(rows)] + [(1000 + i, t, g, "mine") for i, (t, g) in enumerate(extra)], "pos long, text string, lang string, confidence string")
    return {r.pos - 1000: r for r in languages.language_segments(df).collect() if r.pos >= 1000}


def test_mixed_null_blank_foreign_and_short_texts(spark):
    mixed = f"{ENGLISH[0]} {GERMAN[0]} {GERMAN[1]} {SPANISH[2]}"
    foreign = "Мужчина стоит у двери и ждет курьера с посылкой."
    got = _fitted(spark, [(mixed, "en"), (None, "en"), (" \n", None), ("123 !?", "x"), (foreign, None), (ENGLISH[1], "deutsch"), (ENGLISH[1] + " [身份线索] (D/o)", "und"), ("x" * 100_000, None)])
    assert [s.lang for s in got[0].segments] == ["en", "de", "es"] and [mixed[s.start : s.end].strip() for s in got[0].segments][2] == SPANISH[2]
    assert got[0].language == "de" and got[0].confidence < got[5].confidence
    assert all(not got[k].segments and got[k].language is None and got[k].confidence is None for k in (1, 2, 3))
    assert got[4].confidence < 0.5 < 0.8 < got[5].confidence and (got[5].named, got[6].named, got[6].language) == ("de", None, "en")
    assert len(got[7].segments) == 1


def test_labels():
    assert [languages.label_code(x) for x in ("EN", "en-GB", "English (UK)", "中文", "zh_Hans", "pt", "", None, "mul", "N/A")] == ["en", "en", "en", "zh", "zh", "other", None, None, None, None]


def test_no_labels_and_no_rows(spark):
    df = spark.createDataFrame([(1, "some text", None)], "pos long, text string, lang string")
    got = languages.language_segments(df).collect()
    assert got[0].segments == [] and got[0].language is None and languages.language_segments(df.limit(0)).count() == 0


def test_a_small_sample_is_bounded(spark):
    rows = [(i, f"{a} {b} {i}", g) for i, (a, b, g) in enumerate((a, b, g) for g, ts in (("en", ENGLISH), ("de", GERMAN)) for a in ts for b in ts for _ in range(10))]
    df = spark.createDataFrame(rows, "pos long, text string, lang string")
    got = languages.language_segments(df, sample=60).collect()
    assert sum(r.language == r.named for r in got) >= 0.97 * len(got)
