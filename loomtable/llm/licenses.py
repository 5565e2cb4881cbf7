"""Licence scans by canonical digests.

A text is brought to one canonical form, its SHA-256 is looked up among the digests of known licences by an equi-join.
The units are the whole document and each of its lines, so a notice set into other text is found as well.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtable.llm.common import written

#: Equivalent spellings (fixed values: variant words and the one form that they are brought to).
SPELLINGS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled",
    "catalogue": "catalog", "centre": "center", "copyright owner": "copyright holder", "copyright owners": "copyright holders",
    "customisation": "customization", "defence": "defense", "emphasised": "emphasized", "favour": "favor", "fulfil": "fulfill",
    "https": "http", "initialise": "initialize", "judgement": "judgment", "labelling": "labeling", "labour": "labor",
    "licence": "license", "licences": "licenses", "licenced": "licensed", "maximise": "maximize", "modelled": "modeled",
    "non commercial": "noncommercial", "offence": "offense", "optimise": "optimize", "organisation": "organization",
    "per cent": "percent", "practise": "practice", "programme": "program", "realise": "realize", "recognise": "recognize",
    "signalling": "signaling", "sub license": "sublicense", "utilisation": "utilization", "whilst": "while", "wilful": "willful",
}

#: Texts of known licences (fixed values).
_GRANT = 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted'
_ISC_END = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
    "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT '
    "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
KNOWN: dict[str, list[str]] = {
    "MIT": [
        "MIT License\n\nCopyright (c) <year> <copyright holders>\n\nPermission is hereby granted, free of charge, to any person obtaining a copy "
        'of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this "
        "permission notice shall be included in all copies or substantial portions of the Software.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
        "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT",
    ],
    "ISC": [f"ISC License\n{_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n{_ISC_END}", "SPDX-License-Identifier: ISC"],
    "0BSD": [f"{_GRANT}.\n{_ISC_END}", "SPDX-License-Identifier: 0BSD"],
    "BSD-2-Clause": [_BSD_START + _BSD_END, "SPDX-License-Identifier: BSD-2-Clause"],
    "BSD-3-Clause": [
        _BSD_START + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission. " + _BSD_END,
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-only"],
    "CC0-1.0": ["SPDX-License-Identifier: CC0-1.0"],
}


def _add(name: str, *texts: str) -> None:
    KNOWN.setdefault(name, []).extend(texts)


#: Whole texts, one file each by name; where terms have an appendix, the terms alone as well.
for _file in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
    _whole = _file.read_text(encoding="utf-8")
    _add(_file.stem, _whole)
    if (_end := re.search(r"END OF TERMS AND CONDITIONS", _whole)) is not None:
        _add(_file.stem, _whole[: _end.end()], _whole[: _end.start()])

#: Usual notices of licences by their full names, and of the Creative Commons family (name, kind in words, versions).
for _name, _full in {
    "AGPL-3.0": "GNU Affero General Public License, version 3", "GPL-2.0": "GNU General Public License, version 2",
    "GPL-3.0": "GNU General Public License, version 3", "LGPL-2.1": "GNU Lesser General Public License, version 2.1",
    "LGPL-3.0": "GNU Lesser General Public License, version 3",
}.items():
    _v = _full.replace(", version", " version")
    _add(_name, *[f"{how} the {_full}" for how in ("Licensed under", "Released under", "This work is licensed under", "This program is licensed under")])
    _add(_name, *[f"Licensed under {s}" for s in (_name, _name.replace("-", " "), _name.replace("-", "v"), _name.removesuffix(".0"), _v.replace(" version ", " v"))])
    _add(_name, *[f"SPDX-License-Identifier: {_name}{end}" for end in ("", "-only", "-or-later")])
for _name, _full in {
    "Apache-2.0": "Apache License 2.0", "BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": "BSD 3-Clause License", "CC0-1.0": "CC0 1.0 Universal",
    "ISC": "ISC License", "MIT": "MIT License", "MPL-2.0": "Mozilla Public License 2.0", "Unlicense": "Unlicense",
}.items():
    _add(_name, *[f"{how} {the}{_full}" for how in ("Licensed under", "Released under", "This work is licensed under", "This project is licensed under") for the in ("", "the ")])
    _add(_name, f"SPDX-License-Identifier: {_name}")
_add("CC0-1.0", "Licensed under CC0 1.0.", "Released under CC0 1.0.")
_add("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.")
for _kind, _full in {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC": "Attribution-NonCommercial",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}.items():
    for _v, _where in (("4.0", "International"), ("3.0", "Unported")):
        _long = f"Creative Commons {_full if _v == '4.0' else _full.replace('NoDerivatives', 'NoDerivs')} {_v}"
        _url = f"creativecommons.org/licenses/{_kind.lower()}/{_v}"
        for _how in ("Licensed under", "Released under", "This work is licensed under", "This content is licensed under"):
            _add(f"CC-{_kind}-{_v}", *[f"{_how} {x}" for x in (f"CC {_kind} {_v}", f"a CC {_kind} {_v} license", f"the CC {_kind} {_v} license")])
            for _license in (f"{_long} {_where} License", f"{_long} License", _long, f"{_long} {_where}"):
                for _the in ("", "a ", "the "):
                    _notice = f"{_how} {_the}{_license}."
                    _add(f"CC-{_kind}-{_v}", _notice, f"{_notice} To view a copy of this license, visit http://{_url}/.")
        _add(f"CC-{_kind}-{_v}", f"SPDX-License-Identifier: CC-{_kind}-{_v}", f"http://{_url}/", f"http://{_url}/legalcode")

#: A copyright line: the word or sign, then a sign, a year, a placeholder or "by"; to the line's end.
COPYRIGHT_LINE = r"(?m)^[^a-z0-9(©\n]*(?:copyright|\(c\)|©)[ \t]*(?:\(c\)|©|[0-9]{4}|<|\[|by\b)[^\n]*$"
NOT_WORD = r"[^\p{L}\p{N}]+"

_COPYRIGHT, _WORD = re.compile(COPYRIGHT_LINE), re.compile(r"[^\W_]+")
_SPELL = re.compile(r"\b(?:" + "|".join(sorted(SPELLINGS, key=len, reverse=True)) + r")\b")


def canonical(text: str | None) -> str:
    """Small letters, no copyright lines, words alone with one space between, equivalent spellings made one."""
    low = (text or "").lower()
    return _SPELL.sub(lambda m: SPELLINGS[m.group()], " ".join(_WORD.findall(_COPYRIGHT.sub("", low))))


def digests(known: Mapping[str, list[str]] = KNOWN) -> list[tuple[str, str]]:
    """(digest, licence) of every known text, without repeats; if two licences share a text the first by name has it."""
    found: dict[str, str] = {}
    for name in sorted(known):
        for text in known[name]:
            found.setdefault(hashlib.sha256(canonical(text).encode()).hexdigest(), name)
    return sorted(found.items())


def known_table(spark: SparkSession, known: Mapping[str, list[str]] = KNOWN) -> DataFrame:
    return spark.createDataFrame(digests(known), "digest string, license string")


def scan(docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, digest (of the whole text), license (of the whole text, or null), line_licenses (sorted, comma-joined) of every row.

    A text of any length is looked up whole. Null, empty and wordless texts have the digest of nothing and no licence; so has any table of ``known`` (digest,
    license) that lists that digest. Lines that have no word are not looked up. If ``known`` repeats a digest the first
    licence by name counts. Rows that repeat an id are scanned each, an empty table gives no rows, other columns are
    ignored. The join is left to the planner: a small table of digests is broadcast below its checked threshold, and a
    large one is shuffled with hot digests split.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    empty = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            whole, lines = [], []
            for t in b.column(1).to_pylist():
                whole.append(hashlib.sha256(canonical(t).encode()).hexdigest())
                found = {hashlib.sha256(c.encode()).hexdigest() for x in (t or "").split("\n") if (c := canonical(x))}
                lines.append(sorted(found | {whole[-1]}))
            yield pa.record_batch([b.column(0), pa.array(whole), pa.array(lines, pa.list_(pa.string()))], names=["doc_id", "digest", "lines"])

    one = known.where(F.col("digest") != empty).groupBy("digest").agg(F.min("license").alias("license"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t")).mapInArrow(run, f"doc_id {kind}, digest string, lines array<string>")
    key = F.unhex(F.md5(F.concat_ws("\n", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digest", F.array_join("lines", ","))))
    rows = written(rows.withColumn("row", key))  # rows that share it have the same licences
    hits = rows.select("row", "digest", F.explode("lines").alias("line")).join(one.withColumnRenamed("digest", "line"), "line")
    by_row = hits.groupBy("row").agg(
        F.min(F.when(F.col("line") == F.col("digest"), F.col("license"))).alias("license"),
        F.array_join(F.sort_array(F.collect_set("license")), ",").alias("line_licenses"),  # licences of one document
    )
    return rows.join(by_row, "row", "left").select("doc_id", "digest", "license", F.coalesce("line_licenses", F.lit("")).alias("line_licenses"))


def sql() -> str:
    """DuckDB SQL of ``scan`` over ``documents`` and the known licences."""

    def canon(x: str) -> str:
        x = f"trim(regexp_replace(regexp_replace(lower({x}), '{COPYRIGHT_LINE}', '', 'g'), '{NOT_WORD}', ' ', 'g'))"
        for a in sorted(SPELLINGS, key=len, reverse=True):
            x = f"regexp_replace({x}, '\\b{a}\\b', '{SPELLINGS[a]}', 'g')"
        return x

    values = ", ".join(f"('{d}', '{name}')" for d, name in digests())
    return f"""
WITH k(digest, license) AS (VALUES {values}),
w AS (SELECT doc_id, sha256({canon("coalesce(text, '')")}) AS digest FROM documents),
l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x FROM documents),
u AS (SELECT doc_id, digest AS line FROM w UNION SELECT doc_id, sha256(c) FROM (SELECT doc_id, {canon("x")} AS c FROM l) WHERE c <> ''),
h AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS line_licenses FROM u JOIN k ON u.line = k.digest GROUP BY doc_id)
SELECT w.doc_id, w.digest, k.license, coalesce(h.line_licenses, '') AS line_licenses
FROM w LEFT JOIN k ON w.digest = k.digest LEFT JOIN h ON w.doc_id = h.doc_id
"""
