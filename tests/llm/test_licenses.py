"""Licences by canonical digests."""

from edgeledger.llm import license_digests as licenses
from edgeledger.llm.common import numbered, slim
from tests.llm import cases

MIT = licenses.known_licenses()[0][1]


def hits(spark, texts, **more):
    rows = [(k, t, None, None, 0) for k, t in enumerate(texts)]
    stored, row = numbered(cases.table(spark, rows), "t")
    return {r["doc_id"]: (r["license"], r["notices"]) for r in licenses.license_hits(slim(stored, row), **more).collect()}


def test_spellings_marks_and_copyright_lines(spark):
    varied = "The MIT Licence (MIT)\n\nCopyright (c) 2020 Jane Doe\n© 2019-2021 Others\n\n" + MIT.replace("\n", "  ").replace('"', "“").upper()
    got = hits(spark, [varied, MIT + " more", "released under the mit licence!", None, "", "Copyright 2020 X", "no licence"])
    assert got[0] == ("MIT", ["MIT"])  # its long line is the whole grant
    assert got[1] == (None, [])
    assert got[2] == ("MIT", ["MIT"])
    assert [got[k] for k in (3, 4, 5, 6)] == [(None, [])] * 4


def test_notices_on_lines(spark):
    text = "Some words\nLicensed under CC BY-NC 4.0.\nmore\nSPDX-License-Identifier: ISC\nLicensed under CC BY-NC 4.0."
    assert hits(spark, [text])[0] == (None, ["CC-BY-NC-4.0", "ISC"])


def test_own_table_and_spark_form_agree(spark):
    texts = ["A-B  c", "É “x” — y", "whilst\x00the organisation", "sub-\nlicence"]
    got = hits(spark, texts, known=[(f"n{k}", t) for k, t in enumerate(texts)])
    assert [got[k][0] for k in range(4)] == ["n0", "n1", "n2", "n3"]


def test_awkward_tables(spark):
    stored, row = numbered(cases.clashing(spark), "t")
    assert licenses.license_hits(slim(stored, row)).count() == len(cases.PLAIN)
    stored, row = numbered(cases.odd(spark), "t")
    assert licenses.license_hits(slim(stored, row)).count() == len(cases.ODD) + len(cases.PLAIN)
    stored, row = numbered(cases.empty(spark), "t")
    assert licenses.license_hits(slim(stored, row)).count() == 0
