import pytest
from pyspark.sql import functions as F

from qafila.llm import pii as P

CASES = [
    ("Write to ann.lee@mail.site.example. Bye", [("email", "ann.lee@mail.site.example")]),
    ("Replies go to <x1 [at] a-b [dot] test>.", [("email", "x1 [at] a-b [dot] test")]),
    ("x1+v(at)post.a.example is my inbox", [("email", "x1+v(at)post.a.example")]),
    ("Write to me_2 at mail.site dot example. Ok", [("email", "me_2 at mail.site dot example")]),
    ("البريد: ab＠c.test", [("email", "ab＠c.test")]),
    ("mailto:a @ b.test now", [("email", "a @ b.test")]),
    ("MAILTO:BIG@MAIL.SITE.TEST", [("email", "BIG@MAIL.SITE.TEST")]),
    ("Posted by @handle. See https://a.test/x/1 .", []),
    ("look at the tree dot com", []),
    ("Call +999 (0)12 555 0101.", [("phone", "+999 (0)12 555 0101")]),
    ("+999 12 555 0101 x", [("phone", "+999 12 555 0101")]),
    ("هاتف: ٠٣١-٥٥٥-٠١٧٦", [("phone", "٠٣١-٥٥٥-٠١٧٦")]),
    ("(023) 555-0101 or 023/5550102 or 023 55 50 103 or 00999 12 555 0104", [("phone", "(023) 555-0101"), ("phone", "023/5550102"), ("phone", "023 55 50 103"), ("phone", "00999 12 555 0104")]),
    ("call zero two three five five five zero one zero nine", [("phone", "zero two three five five five zero one zero nine")]),
    ("Order 555-471184 was void. Dated 2019-03-13, v5.56.1. Paid 56,554.00 dinars. Lines 12:58-14:58. MS 9216/38. Cat. no. 512-4-51997-735-2.", []),
    ("Accession 6204169733 lists it", []),
    ("passport 364-01-8136 Here", [("id_number", "364-01-8136")]),
    ("Identity card: N90455683T\n", [("id_number", "N90455683T")]),
    ("ID no. QW3814749. My national number is 54.093.399-1.", [("id_number", "QW3814749"), ("id_number", "54.093.399-1")]),
    ("جَواز السفر ٥٥٦٤ ١٥٩٦ ٨٤، ثم", [("id_number", "٥٥٦٤ ١٥٩٦ ٨٤")]),
    ("I live at 7 Cistern Ave., Ras Shira. Then", [("address", "7 Cistern Ave., Ras Shira")]),
    ("to Flat 7, 222 Orchard Terrace, Husn Rumman 70769.", [("address", "Flat 7, 222 Orchard Terrace, Husn Rumman 70769")]),
    ("Address: 65-B Kiln Quay\nHusn Rumman 07230\n", [("address", "65-B Kiln Quay\nHusn Rumman 07230")]),
    ("went to Lantern Avenue 100, 17818 Husn Rumman by mistake", [("address", "Lantern Avenue 100, 17818 Husn Rumman")]),
    ("at P.O. Box 6966, Ras Shira. A", [("address", "P.O. Box 6966, Ras Shira")]),
    ("Lantern Terrace is only an image here. ذكر شارع الرمان في المطلع.", []),
    ("أسكن في حي الفنار، زقاق ٨٩، منزل ١٤، رأس الشراع. ثم", [("address", "حي الفنار، زقاق ٨٩، منزل ١٤، رأس الشراع")]),
    ("إلى ص.ب. 4757، رأس الشراع.", [("address", "ص.ب. 4757، رأس الشراع")]),
    ("My name is Nora K. Field-Marsh and I", [("person_name", "Nora K. Field-Marsh")]),
    ("Yours, N. Field\n", [("person_name", "N. Field")]),
    ("Copied for us by Dr. FIELD, Nora. The", [("person_name", "FIELD, Nora")]),
    ("late. Rana B. Marsh read the proofs.", [("person_name", "Rana B. Marsh")]),
    ("قرأ نوح يوسف بلماوي هذا البيت", [("person_name", "نوح يوسف بلماوي")]),
    ("شكرا للأستاذة د. حسروش على النسخة", [("person_name", "د. حسروش")]),
    ("It is credited to Nuh b. Yusuf Hasadi. ينسب إلى نوح بن يوسف السكراقفي.", []),
    ("My colleague Anna Keller agrees", [("person_name", "Anna Keller")]),
    ("Best, Anna Keller", [("person_name", "Anna Keller")]),
    ("Name: Maria Gomez", [("person_name", "Maria Gomez")]),
    ("Dr. Maria Gomez met us", [("person_name", "Maria Gomez")]),
    ("please call John Smith at noon", [("person_name", "John Smith")]),
    ("I met Peter van Dyke yesterday", [("person_name", "Peter van Dyke")]),
    ("Yours, Sami al-Haddad", [("person_name", "Sami al-Haddad")]),
    ("(555) 123-4567", [("phone", "(555) 123-4567")]),
    ("call 555-123-4567", [("phone", "555-123-4567")]),
    ("SSN 123-45-6789", [("id_number", "123-45-6789")]),
    ("12 Rose Hill, Oldtown", [("address", "12 Rose Hill, Oldtown")]),
    ("jane dot doe at mail dot example", [("email", "jane dot doe at mail dot example")]),
    ("Thanks to all readers. It was written by hand in 1901 and belongs to whoever finds it. Regards, see you soon", []),
    ("BOTH LINES WERE FOUND TRANSCRIBED TWICE", []),
]


@pytest.mark.parametrize("text, want", CASES)
def test_cases(text, want):
    assert [(k, text[a:b]) for k, a, b in P.spans(text)] == want


def test_offsets_survive_removed_characters():
    text = "ك​ـلاَم a​b@c.te­st ok"
    ((kind, a, b),) = P.spans(text)
    assert kind == "email" and text[a] == "a" and text[b - 1] == "t" and text[:a] + "[EMAIL]" + text[b:] == "ك​ـلاَم [EMAIL] ok"


def test_look_alike_letters_in_an_address():
    text = "write to аnn@site.test"  # the first letter is Cyrillic
    assert [(k, text[a:b]) for k, a, b in P.spans(text)] == [("email", "аnn@site.test")]


def test_tables(spark):
    rows = [(1, "Yours, N. Field\nCall 023-555-0101", 5), (2, None, 5), (3, "", 5), (4, " ", 5), (1, "x", 5), (6, "a b " * 60_000 + "x@y.test", 5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, kind int")
    got = sorted((r.doc_id, r.kind, r.start_pos) for r in P.find_details(df).collect())
    assert got == [(1, "person_name", 7), (1, "phone", 21), (6, "email", 240_000)]
    out = [r for r in P.redact(df).collect() if r.doc_id < 4]
    assert {r.text: r.redacted for r in out} == {rows[0][1]: "Yours, [PERSON_NAME]\nCall [PHONE]", None: None, "": "", "x": "x"}
    assert P.find_details(df.filter(F.lit(False))).count() == 0


@pytest.mark.parametrize("rows", [5_000_000, 0])
def test_credits_and_known_names(spark, monkeypatch, rows):
    """Names in the table of credits are no case, whichever way they are held against it."""
    monkeypatch.setattr(P, "CREDIT_ROWS", rows)
    texts = [(1, "Yours, Sami al-Haddad\nMy name is rana marsh and I"), (2, "Yours, Nuh Hasadi"), (2, "قرأ نوح بلماوي هذا البيت. Name: Nuh Hasadi"), (3, None), (4, "")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").withColumns({"spelling": F.lit(1), "d": F.lit(2)})
    credits = spark.createDataFrame([("Nuh  Hasadi",), ("Nuh Hasadi",), (None,)], "poet_name string")
    given = spark.createDataFrame([("Rana",), (None,)], "latin_form string")
    got = sorted((r.doc_id, r.kind, r.start_pos) for r in P.find_details(docs, credits=credits, given_names=given).collect())
    assert got == [(1, "person_name", 7), (1, "person_name", 33), (2, "person_name", 4)]
    out = sorted((r.doc_id, r.redacted or "", r.spelling) for r in P.redact(docs, credits=credits, given_names=given).collect())
    assert out == [(1, "Yours, [PERSON_NAME]\nMy name is [PERSON_NAME] and I", 1), (2, "Yours, Nuh Hasadi", 1), (2, "قرأ [PERSON_NAME] هذا البيت. Name: Nuh Hasadi", 1), (3, "", 1), (4, "", 1)]
