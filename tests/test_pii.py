import random

import pytest
from pyspark.sql import functions as F

from textmill.operators import pii
from textmill.operators.gazetteer import listed_entities

CASES = {
    "EMAIL_ADDRESS": ("mail jan.de-boer@example.nl nu", "jan.de-boer@example.nl"),
    "IP_ADDRESS": ("host 192.168.1.20 up", "192.168.1.20"),
    "PHONE_NUMBER": ("bel +31 20 123 4567 nu", "+31 20 123 4567"),
    "URL": ("zie https://www.example.org/a?b=c nu", "https://www.example.org/a?b=c"),
    "BANK_ACCOUNT": ("iban NL91ABNA0417164300 ok", "NL91ABNA0417164300"),
    "CREDIT_CARD": ("kaart 4111 1111 1111 1111 ok", "4111 1111 1111 1111"),
    "CREDIT_CARD_EXPIRATION": ("exp 04/27 ok", "04/27"),
    "CVV": ("CVC: 123 ok", "123"),
    "SSN": ("bsn 111222333 ok", "111222333"),
    "PASSPORT_NUMBER": ("paspoort NWR1234 5 of NWR12345 ok", "NWR12345"),
    "DRIVER_LICENSE": ("rijbewijs nr. 1234567890 ok", "1234567890"),
    "HEALTHCARE_NUMBER": ("polis 123456789 ok", "123456789"),
    "NUMERICAL_PII": ("klant 12345678 ok", "12345678"),
    "LOCATION_ZIP": ("te 1234 AB Delft", "1234 AB"),
    "LOCATION_COORDINATE": ("op 52.3702, 4.8952 dus", "52.3702, 4.8952"),
    "VEHICLE_ID": ("auto GB-123-K rijdt", "GB-123-K"),
}
INVALID = [
    "999.1.1.1", "NL92ABNA0417164300", "4111 1111 1111 1112", "13/27", "111222334", "OW123456", "0234 AB", "01-02-24",
]


def found(spark, text, types=None):
    df = spark.createDataFrame([(1, text)], "id long, text string")
    return df.select(pii.detect(F.col("text"), types).alias("f")).first().f


def test_every_type_is_found_in_place(spark):
    rows = [(t, text) for t, (text, _) in CASES.items()]
    df = spark.createDataFrame(rows, "type string, text string")
    for row in df.select("type", "text", pii.detect(F.col("text")).alias("f")).collect():
        hits = [e for e in row.f if e.type == row.type]
        assert [e.entity for e in hits] == [CASES[row.type][1]], row.type
        assert row.text[hits[0].start : hits[0].end] == hits[0].entity


def test_check_digits_and_shapes_reject(spark):
    for text in INVALID:
        assert found(spark, f"a {text} b") == [], text


def test_sentinel_in_the_text_moves_nothing(spark):
    hit = found(spark, "a\u0001b x@example.com \u0001", ["EMAIL_ADDRESS"])
    assert [(e.start, e.entity) for e in hit] == [(4, "x@example.com")]


def test_overlaps_fuse_without_leaving_text(spark):
    df = spark.createDataFrame([(1, "zie https://example.org/u@example.com en 04/27")], "id long, text string")
    got = pii.with_entities(df).first().entities
    assert [(e.type, e.entity) for e in got] == [
        ("URL", "https://example.org/u@example.com"), ("CREDIT_CARD_EXPIRATION", "04/27"),
    ]
    chain = F.array(*[
        F.struct(F.lit(s).alias("start"), F.lit(e).alias("end"), F.lit(t).alias("type"), F.lit("?").alias("entity"), F.lit(False).alias("public"))
        for s, e, t in ((0, 5, "NAME"), (4, 10, "URL"), (9, 16, "SSN"), (20, 22, "CVV"))
    ]).cast(pii.ENTITIES)
    fused = df.select(pii.resolve_overlaps(chain, F.col("text")).alias("r")).first().r
    assert [(e.start, e.end, e.type) for e in fused] == [(0, 16, "SSN"), (20, 22, "CVV")]


def test_markers_number_entities(spark):
    text = "a@x.com b@x.com a@x.com 10.0.0.1"
    df = spark.createDataFrame([(1, text)], "id long, text string")
    out = pii.mask_documents(df, replacement_type="MARKER").first()
    assert out.text == "[EMAIL_ADDRESS_1] [EMAIL_ADDRESS_2] [EMAIL_ADDRESS_1] [IP_ADDRESS_1]"
    assert out.PII.entity_types == ["EMAIL_ADDRESS", "IP_ADDRESS"]
    assert out.PII.entity_type_counts == [3, 1]
    assert dict(zip(out.PII.processed_entities, out.PII.processed_entity_counts)) == {"a@x.com": 2, "b@x.com": 1, "10.0.0.1": 1}


def test_far_mentions_are_other_entities(spark):
    near, far = "a@x.com" + " z" * 100 + " a@x.com", "a@x.com" + " z" * 4000 + " a@x.com"
    df = spark.createDataFrame([(1, near), (2, far)], "id long, text string")
    texts = {r.id: r.text for r in pii.mask_documents(df, replacement_type="MARKER").collect()}
    assert texts[1].count("[EMAIL_ADDRESS_1]") == 2
    assert texts[2].startswith("[EMAIL_ADDRESS_1]") and texts[2].endswith("[EMAIL_ADDRESS_2]")


def test_long_texts_rebuild_exactly(spark):
    text = "é\U0001f600 " * 700 + "a@x.com " + "w " * 3000 + "10.1.2.3" + " staart"
    df = spark.createDataFrame([(1, text)], "id long, text string")
    out = pii.mask_documents(df, replacement_type="MARKER").first().text
    assert out == text.replace("a@x.com", "[EMAIL_ADDRESS_1]").replace("10.1.2.3", "[IP_ADDRESS_1]")


def test_many_entities_in_one_row(spark):
    text = " ".join(f"u{i}@example.com" for i in range(3000)) + " " + "1/" * 20000
    df = spark.createDataFrame([(1, text)], "id long, text string")
    out = pii.mask_documents(df, replacement_type="MARKER").first().text
    assert out.startswith("[EMAIL_ADDRESS_1] [EMAIL_ADDRESS_2]") and "[EMAIL_ADDRESS_3000]" in out


def test_nothing_is_found_in_masked_text(spark):
    df = spark.createDataFrame([(1, " | ".join(t for t, _ in CASES.values()))], "id long, text string")
    once = pii.mask_documents(df, replacement_type="MARKER").select("id", "text")
    assert once.select(F.size(pii.detect(F.col("text")))).first()[0] == 0


def test_synthetic_values_have_the_shape_and_repeat(spark):
    df = spark.createDataFrame([(1, "mail a@x.com, a@x.com, ip 8.8.8.8, te 1234 AB")], "id long, text string")
    texts = [pii.mask_documents(df, types=None, synthetic_replacement_locale="en-GB").first().text for _ in range(2)]
    assert texts[0] == texts[1]
    assert "a@x.com" not in texts[0] and "8.8.8.8" not in texts[0]
    assert pii.mask_documents(df, synthetic_replacement_chance=0.0).first().text.count("[EMAIL_ADDRESS_1]") == 2


@pytest.fixture(scope="module")
def terms(spark):
    return spark.createDataFrame(
        [("Jan", "NAME_GIVEN", False), ("Jan Jansen", "NAME", False), ("Dorpsstraat 12 Delft", "LOCATION_ADDRESS", False), ("Rembrandt", "NAME", True)],
        "term string, type string, public boolean",
    )


def test_both_gazetteer_ways_agree(spark, terms):
    rows = [(1, "Jan en Jan Jansen, Dorpsstraat 12 Delft"), (2, "Jan  Jansen"), (3, "Rembrandt schilderde"), (4, "niets")]
    df = spark.createDataFrame(rows, "id long, text string")
    in_row = df.select("id", F.array_sort(listed_entities(F.col("text"), terms)).alias("e")).where(F.size("e") > 0)
    joined = pii.gazetteer_matches(df, terms)
    assert {r.id: r.e for r in in_row.collect()} == {r.id: r.entities for r in joined.collect()}


def test_public_figures_stay(spark, terms):
    df = spark.createDataFrame([(1, "Jan zag Rembrandt en Jan Jansen")], "id long, text string")
    out = pii.mask_documents(df, replacement_type="MARKER", terms=terms).first()
    assert out.text == "[NAME_GIVEN_1] zag Rembrandt en [NAME_2]"
    assert out.PII.not_removed_entities == ["Rembrandt"]
    all_gone = pii.mask_documents(df, replacement_type="MARKER", terms=terms, check_public_figure=False).first()
    assert "Rembrandt" not in all_gone.text
    listed = pii.mask_documents(df, replacement_type="MARKER", terms=terms, figures=["Jan"]).first()
    assert listed.text.startswith("Jan zag")


def test_searches_see_only_what_can_hold_an_entity(spark):
    rng = random.Random(7)
    atoms = [
        "a@b.co", "x.y-z@q.example.com.", "10.0.300.1", "+31 6 12345678", "020-1234567 ", "NL91ABNA0417164300", "4111 1111 1111 1111", "04/25", "cvv:", "CVV2", "123",
        "Driver's licence number is", "rijbewijs", "1234567890", "polis", "zorg", "123456789", "111222333", "1234", "AB", "52.1234, 4.8952", "GB-123-K", "well-known",
        "https://a.b/c", "://", "ſ", "\U0001F600", "漢字", "\u0001",
    ]
    ends = [" ", " ", " ", "  ", "\n", "\t", "", "-", ",", ".", "\r\n"]

    def dull():
        return "".join(rng.choice(["lorem", "dolor-sit", "amet,", "\U0001F600", "漢字"]) + rng.choice([" ", " ", "\n", "", "\f"]) for _ in range(rng.randint(0, 30)))

    texts = ["".join((rng.choice(atoms) if rng.random() < 0.6 else dull()) + rng.choice(ends) for _ in range(rng.randint(1, 25))) for _ in range(1500)]
    texts += [None, "", ":", " " * 200, "x" * 300, "\U0001F600a" * 20000, "\U0001F600 a" * 20000, "漢 字" * 30000 + " a@b.co"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    whole = pii._found(pii.without_sentinel(F.col("text")), pii.DETECTORS)
    assert df.where(~pii.detect(F.col("text")).eqNullSafe(whole)).isEmpty()
    long = spark.createDataFrame([("lorem ipsum " * 500 + "mail a@b.co or c@d.nl " + "dolor sit " * 500,)], "text string")
    pieces = long.select(pii._shortened(F.col("text"))).first()[0]
    assert "".join(pieces) == long.first().text and sum(map(len, pieces[::2])) < 300
