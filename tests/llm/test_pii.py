import re

import pytest

from conftest import plan_of
from ratelens.llm import pii
from ratelens.llm.pii import with_surrogates

MENTIONS = re.compile(r"[\w.]+@[\w.-]+\w|\+\d+ \(\d+\) \d+-\d+|(?<![\d.])\d+\.\d+\.\d+\.\d+|\d{13,19}")


def replaced(df, key="k"):
    return with_surrogates(df, key).collect()


def test_every_kind_in_its_format(documents):
    text = ("mail ann.lee42@mail7.example.com, call +1 (017) 555-7713 or +49 170 5557713; host 10.0.0.1. "
            "card 9807915762804490! Frau Anna Braun and Herr Kim; госпожа нет, Госпожа Иванова.")
    row = replaced(documents((1, text)))[0]
    assert row.n_entities == 8
    new = row.text
    for m in ("ann.lee42", "mail7", "017) 555", "5557713", "10.0.0.1", "9807915762804490", "Braun", "Kim", "Иванова"):
        assert m not in new
    assert re.search(r"mail [a-z]{3}\.[a-z]{3}\d\d@[a-z]{4}\d\.example\.com, call \+1 \(\d{3}\) \d{3}-\d{4} or "
                     r"\+4\d \d{3} \d{7}; host \d+\.\d+\.\d+\.\d+\. card \d{16}! Frau [A-Z][a-z]+a [A-Z][a-z]+a "
                     r"and Herr [A-Z][a-z]+[nrks]; госпожа нет, Госпожа [А-Я][а-я]+а\.", new), new
    for span in row.spans.split(","):
        kind, a, b = span.split(":")
        assert new[int(a):int(b)].strip() and kind in pii.PATTERNS


def test_one_entity_one_surrogate(documents):
    rows = replaced(documents((1, "A.B@example.org and a.b@example.org"), (2, "ask a.b@example.org"),
                              (3, "A.B@EXAMPLE.ORG"), (4, "+1 (017) 555-7713"), (5, "+1 017 5557713")))
    by = {r.doc_id: r.text for r in rows}
    mail = by[2][4:]
    assert by[1] == f"{mail} and {mail}" and by[3] == mail.upper() != "A.B@EXAMPLE.ORG"
    assert re.sub(r"\D", "", by[4]) == re.sub(r"\D", "", by[5])


def test_distinct_entities_stay_distinct_and_new(documents):
    # 600 addresses of one letter and two digits: 2100 forms, so draws collide in every round.
    mails = [f"{'bcdfgh'[i % 6]}{i // 6:02d}@example.org" for i in range(600)]
    rows = replaced(documents(*enumerate(mails)))
    new = [r.text for r in rows]
    assert len(set(new)) == 600 and not set(new) & set(mails)
    assert all(re.fullmatch(r"[b-z]\d\d@example\.org", m) for m in new)


def test_too_few_values_is_an_error(documents, monkeypatch):
    monkeypatch.setattr(pii, "MOST_ROUNDS", 3)
    with pytest.raises(RuntimeError, match="too few"):
        replaced(documents(*[(i, f"{c}@example.org") for i, c in enumerate("aeiou")]))


def test_key_decides(documents):
    docs = documents((1, "a1@example.org 10.1.2.3"))
    assert replaced(docs, "one")[0].text == replaced(docs, "one")[0].text != replaced(docs, "two")[0].text


def test_corpus_keeps_no_entity_and_clean_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    old = {r.doc_id: r.text for r in docs.collect()}
    forms = {}
    for row in replaced(docs):
        found = MENTIONS.findall(old[row.doc_id])
        assert row.n_entities == len(found)
        if not found:
            assert row.text == old[row.doc_id]
        for a, b in zip(found, MENTIONS.findall(row.text), strict=True):
            assert a not in row.text and len(a) == len(b) or "." in a
            assert forms.setdefault(a.lower(), b.lower()) == b.lower()
    assert len(set(forms.values())) == len(forms) > 20


def test_odd_rows_and_empty_table(odd_documents, documents):
    rows = replaced(odd_documents)
    assert sorted(((r.doc_id, r.text) for r in rows), key=repr) == \
        sorted(((r.doc_id, r.text) for r in odd_documents.collect()), key=repr)
    assert replaced(documents()) == []
    twice = replaced(documents((None, "a1@example.org"), (None, "a1@example.org")))
    assert len(twice) == 2 and twice[0] == twice[1]


def test_built_in_functions_only(documents):
    plan = plan_of(with_surrogates(documents((1, "a1@example.org")), "k"))
    assert not any(x in plan for x in ("EvalPython", "MapIn", "FlatMapGroups"))


def test_a_full_format_grows(documents):
    rows = replaced(documents(*[(i, f"{c}@example.org") for i, c in enumerate("aeiou")]))
    new = [r.text for r in rows]
    assert len(set(new)) == 5 and all(re.fullmatch(r"[aeiou][a-z]+@example\.org", m) for m in new)


def test_wider_draws_are_written_whole(documents, monkeypatch):
    monkeypatch.setattr(pii, "WIDER_FROM", 0)
    row = replaced(documents((1, "10.0.0.1, 9807915762804490, +49 170 5557713, a1@example.org")))[0]
    assert re.fullmatch(r"\d+\.\d+\.\d+\.\d+:\d{4}, \d{17}, \+4\d \d{3} \d{8}, [aeiou]\d[a-z]@example\.org", row.text), row.text


def test_names_of_any_form(documents):
    text = ("Mr Juan Carlos Lopez met Mr McDonald, Mr O'Brien's dog, Dr Smith, Miss Jones, Prof J. Smith-Hall, "
            "Mr van der Berg and Frau Müller.")
    row = replaced(documents((1, text)))[0]
    assert row.n_entities == 8
    for m in ("Juan", "Carlos", "Lopez", "Donald", "Brien", "Smith", "Jones", "Hall", "Berg", "ller"):
        assert m not in row.text
    word = "[A-Z][a-z]+"
    assert re.fullmatch(rf"Mr {word} {word} {word} met Mr {word}, Mr {word}'s dog, Dr {word}, Miss {word}, "
                        rf"Prof {word} {word}-{word}, Mr van der {word} and Frau {word}\.", row.text), row.text


def test_later_mentions_without_a_title(documents):
    rows = replaced(documents(
        (1, "Mr Juan Lopez called. Lopez said that Juan Lopez left; Lopezian and lopez stay."),
        (2, "Lopez is not named here"), (3, "Mr Juan Lopez"), (4, "Госпожа Иванова. Иванова ушла")))
    by = {r.doc_id: r for r in rows}
    first, last = by[3].text.split(" ")[1:]
    assert by[1].text == f"Mr {first} {last} called. {last} said that {first} {last} left; Lopezian and lopez stay."
    assert by[1].n_entities == 3 and by[2].text == "Lopez is not named here" and by[2].n_entities == 0
    for span in by[1].spans.split(","):
        kind, a, b = span.split(":")
        assert kind == "name" and by[1].text[int(a):int(b)].endswith(last)
    title, one, two, _ = by[4].text.split(" ")
    assert one == two + "." and two != "Иванова"


def test_gender_is_part_of_a_name(documents):
    him, her = replaced(documents((1, "Mr Smith met Mrs Smith")))[0].text[3:].split(" met Mrs ")
    assert him != her and her[-1] == "a" and him[-1] in "nrks"


def test_separators_in_cards_and_national_phones(documents):
    text = "4111 1111 1111 1111, 4111-1111-1111-1111, 3782 822463 10005, (743) 555-3824, 743-555-3824; 2024-01-02 1.5"
    row = replaced(documents((1, text)))[0]
    a, b, c, d, e = row.text.split(";")[0].split(", ")
    assert a.replace(" ", "") == b.replace("-", "") != "4111111111111111" and re.fullmatch(r"\d{4}( \d{4}){3}", a)
    assert re.fullmatch(r"\d{4} \d{6} \d{5}", c) and c != "3782 822463 10005"
    assert re.fullmatch(r"\(\d{3}\) \d{3}-\d{4}", d) and d[1:4] + d[6:9] + d[10:] == e.replace("-", "")
    assert row.text.endswith("; 2024-01-02 1.5")


def test_a_text_in_a_third_of_the_rows(documents):
    copies = [(i, "Mr Juan Lopez, a1@example.org. Lopez") for i in range(300)]
    rows = replaced(documents(*copies, *[(300 + i, f"b{i}@example.org") for i in range(600)]))
    assert len(rows) == 900 and len({r.text for r in rows if r.doc_id < 300}) == 1
    assert len({r.text for r in rows if r.doc_id >= 300}) == 600
