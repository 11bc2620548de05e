"""License scans by canonical digests.

A text is brought to a canonical form: A-Z in lower case, copyright lines out, punctuation and white
space to single spaces, equivalent spellings to one. The digest of the form is joined with the
digests of known licences. Whole texts are looked up, and each line as a text of its own, as notices
stand on lines.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeledger.llm.common import documents, land, let, lower_ascii, numbered, slim

# Spellings that count as equal, by the public guidelines for matching licences.
SPELLINGS = [
    ("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"),
    ("per cent", "percent"), ("https", "http"), ("organisation", "organization"),
    ("authoris", "authoriz"), ("favour", "favor"), ("fulfil ", "fulfill "), ("judgement", "judgment"),
    ("merchantibility", "merchantability"), ("whilst", "while"), ("copyright owner", "copyright holder"),
]

COPYRIGHT_SIGN = r"©|\(c\)"
COPYRIGHT_LINE = r"^[^a-z0-9]*(copyright.*([0-9]{4}|[<\[{]y+|year).*|all rights reserved[. ]*)$"
SEPARATORS = r"[\x00-\x2f\x3a-\x60\x7b-\x7f\x{a0}\x{2013}\x{2014}\x{2018}\x{2019}\x{201c}\x{201d}\x{2022}]+"

# Public licence texts and notices, by their public short names.
_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS
OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC_HEAD = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
NOTICED = [
    ("Apache-2.0", "the Apache License, Version 2.0"), ("Apache-2.0", "the Apache License 2.0"), ("MIT", "the MIT License"),
    ("GPL-2.0", "the GNU General Public License, version 2"), ("GPL-3.0", "the GNU General Public License, version 3"),
    ("LGPL-3.0", "the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "the GNU Affero General Public License, version 3"), ("MPL-2.0", "the Mozilla Public License, v. 2.0"),
    ("BSD-2-Clause", "the BSD 2-Clause License"), ("BSD-3-Clause", "the BSD 3-Clause License"), ("ISC", "the ISC License"),
    ("CC0-1.0", "CC0 1.0"), ("CC-BY-4.0", "CC BY 4.0"), ("CC-BY-SA-4.0", "CC BY-SA 4.0"), ("CC-BY-NC-4.0", "CC BY-NC 4.0"),
    ("CC-BY-ND-4.0", "CC BY-ND 4.0"), ("CC-BY-NC-SA-4.0", "CC BY-NC-SA 4.0"), ("CC-BY-NC-ND-4.0", "CC BY-NC-ND 4.0"),
]
OPENINGS = [
    "Licensed under", "Released under", "Distributed under", "Available under", "This work is licensed under",
    "This software is licensed under", "This project is licensed under", "This file is licensed under",
]


def known_licenses() -> list[tuple[str, str]]:
    """(name, text) of the licences that are looked up."""
    return [
        ("MIT", _MIT_GRANT), ("MIT", "MIT License\n" + _MIT_GRANT), ("MIT", "The MIT License (MIT)\n" + _MIT_GRANT),
        ("ISC", f"{_ISC_HEAD}, provided that the above copyright notice and this permission notice appear in all copies.\n{_ISC_END}"),
        ("0BSD", f"{_ISC_HEAD}.\n{_ISC_END}"),
        ("BSD-2-Clause", f"{_BSD_HEAD}\n{_BSD_END}"), ("BSD-3-Clause", f"{_BSD_HEAD}\n{_BSD_NAMES}\n{_BSD_END}"),
        *((name, f"{opening} {called}.") for name, called in NOTICED for opening in OPENINGS),
        *((name, f"SPDX-License-Identifier: {name}") for name, _ in NOTICED),
    ]


def canonical_text(text: str) -> str:
    """The canonical form in plain Python, for the known texts."""

    def line(x: str) -> str:
        x = re.sub(COPYRIGHT_SIGN, "copyright", x)
        if re.search(COPYRIGHT_LINE, x):
            return ""
        return spelled(re.sub(re.sub(r"\\x\{(\w+)\}", lambda m: f"\\u{m[1]:0>4}", SEPARATORS), " ", x).strip(" "))

    def spelled(x: str) -> str:
        for a, b in SPELLINGS:
            x = x.replace(a, b)
        return x

    lowered = text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
    return spelled(" ".join(filter(None, map(line, lowered.split("\n")))))


def _spelled(text: Column) -> Column:
    for a, b in SPELLINGS:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def _canonical_lines(text: Column) -> Column:
    """The canonical form of each line that has something left."""

    def line(x: Column) -> Column:
        signed = F.regexp_replace(x, COPYRIGHT_SIGN, "copyright")

        def plain(s: Column) -> Column:
            kept = _spelled(F.btrim(F.regexp_replace(s, SEPARATORS, " "), F.lit(" ")))
            return F.when(s.rlike("(?s)" + COPYRIGHT_LINE), "").otherwise(kept)

        return let(signed, plain)

    return F.filter(F.transform(F.split(lower_ascii(text), "\n"), line), lambda x: x != "")


def license_hits(docs: DataFrame, known: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """``row, doc_id, license, notices, n_units`` for each row of ``docs`` (``row, doc_id, text``).

    ``license`` is that of the whole text (null: none), ``notices`` the sorted licences of its lines,
    ``n_units`` how many different lines, the whole text included, have canonical words. Null and
    empty texts have no units and no licence; so have texts of copyright lines alone. ``known`` is a
    fixed list, so its table is small whatever the corpus; of texts with one canonical form the
    least name holds.
    """
    names: dict[str, str] = {}
    for name, text in known_licenses() if known is None else known:
        digest = hashlib.sha256(canonical_text(text).encode()).hexdigest()
        names[digest] = min(name, names.get(digest, name))
    spark = docs.sparkSession
    rows = ", ".join(f"('{digest}', '{name}')" for digest, name in sorted(names.items()))
    table = spark.sql(f"select * from values {rows or "('', '')"} as t(digest, name)")

    def digests(lines: Column) -> Column:
        whole = F.sha2(_spelled(F.array_join(lines, " ")).cast("binary"), 256)
        own = F.transform(lines, lambda x: F.sha2(x.cast("binary"), 256))
        return F.struct(F.when(F.size(lines) > 0, whole).alias("whole"), F.array_distinct(own).alias("lines"))

    found = land(
        docs.select("row", "doc_id", let(_canonical_lines(F.col("text")), digests).alias("d")).select(
            "row", "doc_id", "d.whole", "d.lines",
            F.size(F.array_distinct(F.concat("d.lines", F.array_compact(F.array("d.whole"))))).cast("long").alias("n_units"),
        ),
        "licenses",
    )
    wholes = found.select("row", F.lit(True).alias("is_whole"), F.col("whole").alias("digest"))
    lines = found.select("row", F.lit(False).alias("is_whole"), F.explode("lines").alias("digest"))
    hits = wholes.unionByName(lines).join(table, "digest")
    by_row = hits.groupBy("row").agg(
        F.max(F.when(F.col("is_whole"), F.col("name"))).alias("license"),
        F.array_sort(F.collect_set(F.when(~F.col("is_whole"), F.col("name")))).alias("notices"),
    )
    by_row = land(by_row, "license-hits")
    none = F.array().cast("array<string>")
    return found.join(by_row, "row", "left").select(
        "row", "doc_id", "license", F.coalesce("notices", none).alias("notices"), "n_units"
    )


def op2_license_scan(spark, sf_dir: str) -> DataFrame:
    """The licences of every document; the notices as one text."""
    stored, row = numbered(documents(spark, sf_dir).select("doc_id", "text"), "documents")
    hits = license_hits(slim(stored, row))
    return hits.select("doc_id", "license", F.array_join("notices", ",").alias("notices"), "n_units")


def _sql() -> str:
    def spelled(x: str) -> str:
        for a, b in SPELLINGS:
            x = f"replace({x}, '{a}', '{b}')"
        return x

    names: dict[str, str] = {}
    for name, text in known_licenses():
        digest = hashlib.sha256(canonical_text(text).encode()).hexdigest()
        names[digest] = min(name, names.get(digest, name))
    values = ", ".join(f"('{d}', '{n}')" for d, n in sorted(names.items()))
    return f"""
with known(digest, name) as (values {values}),
l as (select doc_id, unnest(string_split(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), chr(10))) as x,
  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as k from documents),
s as (select doc_id, k, regexp_replace(x, '{COPYRIGHT_SIGN}', 'copyright', 'g') as x from l),
c as (select doc_id, k, {spelled(f"trim(regexp_replace(x, '{SEPARATORS}', ' ', 'g'), ' ')")} as x
  from s where not regexp_matches(x, '(?s){COPYRIGHT_LINE}')),
w as (select doc_id, sha256({spelled("string_agg(x, ' ' order by k)")}) as digest from c where x <> '' group by doc_id),
u as (select distinct doc_id, false as is_whole, sha256(x) as digest from c where x <> ''
  union all select doc_id, true, digest from w),
h as (select doc_id, max(name) filter (is_whole) as license,
    string_agg(distinct name, ',' order by name) filter (not is_whole) as notices, count(distinct u.digest) as n_units
  from u left join known using (digest) group by doc_id)
select d.doc_id, h.license, coalesce(h.notices, '') as notices, coalesce(h.n_units, 0) as n_units
from documents d left join h using (doc_id)
"""


OP2_SQL = _sql()
