from ratelens.llm.licenses import TEMPLATES, scan

NOTICES = {"GPL": "This work is licensed under the GNU General Public License, version 3.",
           "CC-BY-NC": "Licensed under CC BY-NC 4.0.", "MIT": "Released under the MIT License.",
           "Apache-2.0": "Licensed under the Apache License, Version 2.0."}


def test_same_as_brute_force_over_the_corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: sorted(r.licences) for r in scan(docs).collect()}
    for doc, text in docs.select("doc_id", "text").collect():
        assert got[doc] == sorted(f for f, notice in NOTICES.items() if notice in text), doc


def test_families_altered_notices_and_unknown(spark, documents):
    corpus = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [(i, t) for f in sorted(TEMPLATES) for i, t in [(10_000 + sorted(TEMPLATES).index(f), "\n".join(TEMPLATES[f][:1]))]]
    rows += [(20_000, "some words\nThis program is licensed under the GNU General Public License version 3 or later\nmore"),
             (20_001, "The licence of the software is to deal in the work under terms"),
             (20_002, "He was the first under the sun and this is the work of many days")]
    got = {r.doc_id: r for r in scan(documents(*map(tuple, corpus), *rows)).collect()}
    for i, family in enumerate(sorted(TEMPLATES)):
        assert got[10_000 + i].licences == [family]
    assert [(f.family, f.paragraph) for f in got[20_000].found] == [("GPL", 1)]
    assert not set(got[20_001].licences) - {"unknown"} and got[20_002].licences == []


def test_odd_rows_and_empty_table(odd_documents, documents):
    rows = scan(odd_documents).collect()
    assert len(rows) == odd_documents.count() and all(r.found == [] for r in rows)
    assert {r.n_paragraphs for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert scan(documents()).collect() == []


def test_frequent_embedded_and_wrapped_notices(spark, documents):
    corpus = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
              .select("doc_id", "text").collect()]
    plain = " ".join(w for _, text in corpus[:3] for w in text.split() if w.isalpha())[:1500]
    mit, gpl = NOTICES["MIT"], NOTICES["GPL"]
    # A third of the rows: one line with the notice amid other words.
    frequent = [(30_000 + i, f"{plain[i:]} {mit} {plain[2 * i:]}") for i in range(len(corpus) // 2)]
    rows = [(40_000, mit), (40_001, f"{plain} {mit} {plain} {gpl} {plain}"),
            (40_002, "This work is licensed under the\nGNU General Public\nLicense, version 3.\n\nother words"),
            (40_003, "This work is licensed under the\n\nother words\n\nPublic License, version 3."),
            (40_004, "\n".join([mit, "other words", mit])),
            (40_005, f"{plain} This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                     f"International License. {plain}")]
    got = {r.doc_id: r for r in scan(documents(*corpus, *frequent, *rows)).collect()}
    assert [i for i, _ in frequent if got[i].licences != ["MIT"]] == []
    assert got[40_000].licences == ["MIT"] and got[40_001].licences == ["GPL", "MIT"]
    assert [(f.family, f.paragraph) for f in got[40_002].found] == [("GPL", 0)]
    assert "GPL" not in got[40_003].licences
    assert [(f.family, f.paragraph) for f in got[40_004].found] == [("MIT", 0), ("MIT", 2)]
    assert got[40_005].licences == ["CC-BY-SA"]
